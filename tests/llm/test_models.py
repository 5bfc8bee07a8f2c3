"""The classifiers' inner parts against plain versions: counts, the dual optimum, gradients, scores; excerpts."""
import itertools
import random
import tracemalloc

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tallyframe.llm import labels, lang_crf, quality_nbsvm


def sparse_rows(rng, n, dims):
    y = np.where(rng.random(n) < 0.4, 1.0, -1.0)
    rows = [np.unique(rng.choice(dims, int(rng.integers(0, 30)), p=np.roll(np.linspace(1, 5, dims), 20 * (y[i] > 0)) / 3 / dims))
            for i in range(n)]
    return rows, y


def test_ratios_equal_counts():
    rows, y = sparse_rows(np.random.default_rng(1), 60, 100)
    ratio = quality_nbsvm.class_ratios(rows, y, 100)
    plus, minus = (np.array([1 + sum(f in x for x, z in zip(rows, y) if z == side) for f in range(100)]) for side in (1, -1))
    want = np.log(plus / plus.sum()) - np.log(minus / minus.sum())
    want[(plus == 1) & (minus == 1)] = 0
    assert np.allclose(ratio, want)


@pytest.mark.parametrize("epochs, gap", [(12, 0.05), (1500, 1e-6)])
def test_descent_reaches_the_optimum(monkeypatch, epochs, gap):
    """The gap between the primal value of the model and the dual value of its multipliers bounds
    the distance from the optimum."""
    rng = np.random.default_rng(2)
    rows, y = sparse_rows(rng, 80, 100)
    ratio, share = quality_nbsvm.class_ratios(rows, y, 100), 0.3
    monkeypatch.setattr(quality_nbsvm, "EPOCHS", epochs)
    weights, bias = quality_nbsvm._descend(rows, y, ratio, share, rng)
    x = np.zeros((80, 101))
    for i, r in enumerate(rows):
        x[i, r] = ratio[r] / max(1.0, np.sqrt(len(r)))
    x[:, 100] = 1
    w = np.append(np.divide(weights, ratio, out=np.zeros(100), where=ratio != 0), bias)
    cost = quality_nbsvm.COST * np.where(y > 0, share / (y > 0).mean(), (1 - share) / (y < 0).mean())
    primal = w @ w / 2 + (cost * np.maximum(0, 1 - y * (x @ w))).sum()
    # a plain solver: projected gradient steps on the dual
    q = (x * y[:, None]) @ (x * y[:, None]).T
    dual = np.zeros(80)
    step = 1 / np.linalg.eigvalsh(q)[-1]
    for _ in range(50_000):
        dual = np.clip(dual + step * (1 - q @ dual), 0, cost)
    best = dual.sum() - dual @ q @ dual / 2
    assert -1e-9 <= (primal - best) / best < gap + 1e-4


def test_fit_holds_little_memory():
    """Long rows: what fitting holds beside the features stays far below the text."""
    rng = random.Random(1)
    texts = [" ".join(f"w{rng.randint(0, 5000)}" for _ in range(1300)) for _ in range(400)]  # 2.6 MB
    rows = [x for lo in range(0, 400, 64) for x in quality_nbsvm.features(pa.array(texts[lo:lo + 64], pa.large_string()))]
    held = sum(x.nbytes for x in rows)
    tracemalloc.start()
    quality_nbsvm.fit_features(rows, [i % 2 for i in range(400)])
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert held < 5 * sum(map(len, texts)) and peak < 60e6


def test_excerpts_are_spread_over_the_text(spark):
    long = " ".join(f"w{i:05d}" for i in range(5000))
    rows = [(1, "short text"), (2, long), (3, "x" * 9000), (4, None), (5, "")]
    got = dict(map(tuple, spark.createDataFrame(rows, "id int, t string").select("id", labels.excerpt(F.col("t"), 800, 8)).collect()))
    assert (got[1], got[4], got[5]) == ("short text", None, "")
    words = got[2].split()
    assert 90 < len(words) <= 115 and all(len(w) == 6 for w in words) and len(got[2]) <= 810
    places = [int(w[1:]) for w in words]
    assert places == sorted(places) and places[0] < 20 and places[-1] > 4970
    assert all(any(lo <= p < lo + 1000 for p in places) for lo in range(0, 5000, 1000))
    assert len(got[3]) <= 810


def chains(rng, n_chains=3, n=3, longest=5):
    length = [int(rng.integers(1, longest + 1)) for _ in range(n_chains)]
    first = np.concatenate([[0], np.cumsum(length)])
    return rng.normal(size=(first[-1], n)), first, rng.normal(size=(n, n))


def enumerated(e, transitions):
    """Log normaliser and log weight of every labelling of one chain."""
    n = e.shape[1]
    paths = list(itertools.product(range(n), repeat=len(e)))
    score = np.array([sum(e[t, y] for t, y in enumerate(p)) + sum(transitions[a, b] for a, b in zip(p, p[1:])) for p in paths])
    return paths, score - np.logaddexp.reduce(score)


def test_training_gradient_equals_differences():
    rng = np.random.default_rng(5)
    e, first, trans = chains(rng)
    size = np.diff(first)
    live = np.arange(size.max()) < size[:, None]
    x = np.zeros((*live.shape, 3), np.float64)
    x[live] = e
    y = rng.integers(0, 3, live.shape)

    def likelihood(x_, t_):
        total = 0.0
        for i, n in enumerate(size):
            paths, logp = enumerated(x_[i, :n], t_)
            total += logp[paths.index(tuple(y[i, :n].tolist()))]
        return total

    marginals, joint = lang_crf._chains(x, trans, live)
    gradient = (np.eye(3)[y] - marginals) * live[:, :, None]
    counts = np.zeros((3, 3))
    np.add.at(counts, (y[:, :-1][live[:, 1:]], y[:, 1:][live[:, 1:]]), 1)
    for index in np.ndindex(*x.shape):
        step = np.zeros_like(x)
        step[index] = 1e-5
        want = (likelihood(x + step, trans) - likelihood(x - step, trans)) / 2e-5 if live[index[:2]] else 0.0
        assert gradient[index] == pytest.approx(want, abs=1e-6)
    for index in np.ndindex(3, 3):
        step = np.zeros((3, 3))
        step[index] = 1e-5
        want = (likelihood(x, trans + step) - likelihood(x, trans - step)) / 2e-5
        assert (counts - joint)[index] == pytest.approx(want, abs=1e-6)


def test_features_of_a_word():
    feats, first = lang_crf._ngrams(["ab", "x", "é"])
    assert np.diff(np.append(first, len(feats))).tolist() == [3 + 2 + 1, 2 + 1, 3 + 2 + 1]  # é is two bytes
    again, _ = lang_crf._ngrams(["ab"])
    assert sorted(again) == sorted(feats[:6])


def test_document_score_is_the_mean_marginal(spark):
    rng = random.Random(4)
    vocab = {"en": "the and of with house water".split(), "de": "der und von mit haus wasser".split(), "fr": "le et de avec maison eau".split()}
    rows = [(lang, " ".join(rng.choice(w) for _ in range(12))) for lang, w in vocab.items() for _ in range(30)]
    model = lang_crf.fit(rows)
    texts = ["the house und", "Wasser 12 avec", "mit", "eau et de the", "!!", "of of le"]
    found = lang_crf.identify(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), model)
    for r in found.collect():
        plain = [w for w in texts[r["doc_id"]].lower().split() if w.isalpha()]
        if not plain:
            assert (r["lang_pred"], r["score"]) == ("und", 0.0)
            continue
        e, trans = model.emissions(plain).astype(float), model.transitions.astype(float)
        e[0] += np.log(np.exp(trans).sum(axis=0))  # a chain enters from a uniform state
        paths, logp = enumerated(e, trans)
        marginal = np.zeros((len(plain), 3))
        for p, lp in zip(paths, logp):
            marginal[range(len(plain)), p] += np.exp(lp)
        mean = marginal.mean(axis=0)
        assert r["lang_pred"] == model.langs[mean.argmax()] and r["score"] == pytest.approx(mean.max(), abs=1e-4)
        assert r["n_switched"] == (marginal.argmax(axis=1) != mean.argmax()).sum()


def test_marginals_do_not_depend_on_their_group(monkeypatch):
    rng = np.random.default_rng(6)
    length = [1] * 50 + [3, 130, 400, 2, 0, 7, 129, 128, 0]
    first = np.concatenate([[0], np.cumsum(length)])
    e, trans = rng.normal(size=(first[-1], 4)), rng.normal(size=(4, 4))
    whole = lang_crf.marginals(e, first, trans)
    monkeypatch.setattr(lang_crf, "WORKING", 500)
    assert np.allclose(lang_crf.marginals(e, first, trans), whole)
    for a, b in zip(first[:-1], first[1:]):
        if b > a:
            assert np.allclose(lang_crf.marginals(e[a:b], np.array([0, b - a]), trans), whole[a:b])


def test_many_languages_and_short_texts_need_little():
    rng = np.random.default_rng(7)
    first, e, trans = np.arange(10_001), rng.normal(size=(10_000, 100)), rng.normal(size=(100, 100))
    tracemalloc.start()
    lang_crf.marginals(e, first, trans)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 150e6  # the result alone has 8 MB


def test_training_with_repeated_ids_loses_no_language(spark):
    rows = [(1, f"alpha beta text {i}", "aa") for i in range(700)] + [(5 + i, "gamma delta word", "zz") for i in range(20)]
    model = lang_crf.train(spark.createDataFrame(rows, "doc_id long, text string, lang string"))
    assert model.langs == ["aa", "zz"]


def test_clashing_columns_stay(spark):
    rows = [(i, "the house and the water of the", "en", "x", 1.0) for i in range(12)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, crf_lang_pred string, CRF_score double")
    left = lang_crf.reject_unidentified(docs)
    assert left.columns == docs.columns and left.count() == 12 and left.first()["crf_lang_pred"] == "x"
