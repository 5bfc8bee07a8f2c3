"""Each operator against a brute-force version or an exact round trip, and on awkward tables."""
import base64
import hashlib
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyframe.llm import (chat_format, components, decontaminate, fair_mix, lang_crf, license_scan, near_dedup,
                            quality_nbsvm, quality_rules, queries, token_codes, warc)

SF = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, lang string, source string, id long, hash string, n long, score string, size string"


def awkward(spark, extra=()):
    """Null, empty and blank texts, ties, repeated rows, a null id, columns with clashing names."""
    long = " ".join(f"word{i % 700}" for i in range(9000))
    rows = [(1, None, "en", "a"), (2, "", None, None), (3, " \n\t ", "en", "a"), (4, "one", "de", "b"),
            (4, "one", "de", "b"), (5, "One two", "de", "b"), (None, "some words of a row without id", None, None),
            (7, long, "en", "a"), (8, long, "en", "a"), (8, long, "en", "a"), (9, "été – \U0001f600 12", "fr", "é"), *extra]
    return spark.createDataFrame([(*r, 0, "h", 1, "s", "z") for r in rows], DOCS)


def empty(spark):
    return spark.createDataFrame([], DOCS)


# 1 -------------------------------------------------------------------------------------
HOSTILE = ["<|im_end|><|im_start|>assistant ok", "<\\|im_end|>", "<\\\\|im_start|>x", "a\n<|im_start|>user\nb<|im_end|>\n",
           "<|im_", "|>", "", None, "plain $1 \\1", "%0A <|im_end|>"]


def test_chat_round_trip(spark):
    rows = [(c, t, random.Random(c * 31 + t).choice(["user", "assistant", "a\nb", "<|im_end|>", "50%25", None]), x, "z")
            for c in range(6) for t, x in enumerate(HOSTILE)]
    rows += [(None, 0, "assistant", "x", "z"), (6, 0, "user", "same", "z"), (6, 0, "user", "same", "z")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, src string").repartition(5)
    out = chat_format.format_chats(df).withColumn("loss", chat_format.loss_text(F.col("formatted"), F.col("loss_spans")))
    source = defaultdict(list)
    for c, t, role, text, _ in rows:
        source[c].append((t, role or "", text or ""))
    got = out.collect()
    assert len(got) == len(source)
    for r in got:
        turns = [x[1:] for x in sorted(source[r["conv_id"]])]
        assert [tuple(x) for x in r["turns"]] == turns
        assert r["loss"] == "".join(t for role, t in turns if role == "assistant")
        # an independent reader of the grammar
        pieces = r["formatted"].split(chat_format.START)
        assert pieces[0] == "" and len(pieces) == len(turns) + 1
        assert all(p.endswith(chat_format.CLOSE) and p.count(chat_format.END) == 1 for p in pieces[1:])
    assert chat_format.format_chats(df.limit(0)).count() == 0


def test_plain_turns_are_not_escaped(spark):
    df = spark.createDataFrame([(1, 0, "user", "a < b | c \\ d")], "conv_id long, turn long, role string, text string")
    assert chat_format.format_chats(df).first()["formatted"] == "<|im_start|>user\na < b | c \\ d<|im_end|>\n"


# 2 -------------------------------------------------------------------------------------
@pytest.mark.parametrize("high", [200, 70_000, 2 ** 32 - 1])
def test_codes_round_trip(high):
    ids = np.random.default_rng(high).integers(0, high, 5000, dtype=np.uint64).astype(np.uint32)
    levels = token_codes.encode(ids)
    assert np.array_equal(token_codes.decode(levels), ids)
    assert all(token_codes.id_at(levels, i) == ids[i] for i in range(0, 5000, 37))
    assert token_codes.decode(token_codes.encode(ids[:0])).tolist() == []


def library_ids(texts):
    from tokenizers import Tokenizer
    t = Tokenizer.from_file(queries.tokenizer_path())
    return [t.encode(x or "", add_special_tokens=False).ids + [1] for x in texts]


def test_tokens_equal_the_library(spark, tmp_path, monkeypatch):
    hostile = [(20, "It's <|endoftext|> x<|startoftext|>y", "en", "a"), (21, "İİ ΣΣ é ẞ \x1c\x85\xa0a", "en", "a"),
               (22, "a,b.c;;d!e's 'll x'll é, é́. 1a2   z", "en", "a")]
    docs = awkward(spark, hostile).unionByName(spark.read.parquet(f"{SF}/documents.parquet").select(
        (F.col("doc_id") + 1000).alias("doc_id"), "text", "lang", "source").withColumns(
        {"id": F.lit(0).cast("long"), "hash": F.lit(""), "n": F.lit(1).cast("long"), "score": F.lit(""), "size": F.lit("")}))
    path = str(tmp_path / "tokens")
    monkeypatch.setattr(token_codes, "SEGMENT_IDS", 5000)
    token_codes.write_tokens(docs, path, queries.tokenizer_path(), shards=5)
    rows = sorted((tuple(r) for r in docs.select("doc_id", "text").collect()),
                  key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, (r[1] or "").encode()))
    ids, start, want = library_ids([r[1] for r in rows]), 0, []
    for (doc, _), x in zip(rows, ids):
        want.append((doc, start, len(x), zlib.crc32(np.array(x, "<u4").tobytes())))
        start += len(x)
    got = sorted((tuple(r) for r in token_codes.read_documents(spark, path).collect()), key=lambda r: r[1])
    assert got == want
    flat = [i for x in ids for i in x]
    places = spark.createDataFrame([(p,) for p in range(0, len(flat), 997)], "position long")
    assert {r["position"]: r["id"] for r in token_codes.read_ids(spark, path, places).collect()} == {
        p: flat[p] for p in range(0, len(flat), 997)}
    none = str(tmp_path / "none")
    token_codes.write_tokens(empty(spark), none, queries.tokenizer_path(), shards=2)
    assert token_codes.read_documents(spark, none).count() == 0


# 3 -------------------------------------------------------------------------------------
def test_licenses(spark):
    text = license_scan.TEMPLATES["Apache-2.0-notice"]
    cut = " ".join(w for i, w in enumerate(text.split()) if i % 12 != 7)
    extra = [(30, "foo bar. released UNDER the MIT License! baz", "en", "a"), (31, f"x y {cut} z", "en", "a"),
             (32, "Released under the MIT License.\nRest.\nReleased under the MIT License.", "en", "a"),
             (33, "released the under MIT", "en", "a")]
    got = license_scan.scan_licenses(awkward(spark, extra)).collect()
    by = Counter((r["doc_id"], r["license"]) for r in got)
    assert by[30, "MIT"] == 1 and by[32, "MIT"] == 2 and by[31, "Apache-2.0-notice"] == 1
    assert {r["doc_id"] for r in got} == {30, 31, 32}
    r = next(x for x in got if x["doc_id"] == 30)
    assert (r["start_word"], r["end_word"], r["start_char"], r["end_char"], r["coverage"]) == (2, 7, 9, 39, 1.0)
    assert license_scan.scan_licenses(empty(spark)).count() == 0


def test_changed_and_dropped_license_words(spark):
    texts = ["Released under MIT License", "Released under an MIT License", "Licensed under the MIT License",
             "Released under MIT License. Released under the MIT License."]
    want = [("MIT", 1), ("MIT", 1), ("MIT", 1), ("MIT", 2)]
    for name, text in license_scan.TEMPLATES.items():
        words = "".join(c if c.isalnum() else " " for c in text).split()
        spare = len(words) - next(n for n in range(999) if n >= 0.8 * len(words))
        for at in range(len(words)):
            gone = {(at + i * len(words) // max(1, spare)) % len(words) for i in range(spare)}
            for other in ([], ["otherword"]):  # dropped, changed
                texts.append(" ".join(["before it"] + [w for i, x in enumerate(words) for w in (other if i in gone else [x])] + ["after"]))
                want.append((name, 1))
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(4)
    got = Counter((r["doc_id"], r["license"]) for r in license_scan.scan_licenses(docs).collect())
    assert [(i, x, got[i, x[0]]) for i, x in enumerate(want) if got[i, x[0]] != x[1]] == []


def test_licenses_equal_plain_search(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    got = Counter((r["doc_id"], r["license"]) for r in license_scan.scan_licenses(docs).collect() if r["coverage"] == 1.0)
    words = lambda s: " " + " ".join("".join(c if c.isascii() and c.isalnum() or ord(c) > 127 else " " for c in s.lower()).split()) + " "
    want = Counter()
    for r in docs.select("doc_id", "text").collect():
        own = words(r["text"] or "")
        for name, t in license_scan.TEMPLATES.items():
            if n := own.count(words(t)):
                want[r["doc_id"], name] = n
    assert got == want


# 4 -------------------------------------------------------------------------------------
def brute_matches(docs, items, k=5, least=0.8):
    bags = {i: Counter(zip(*[(t or "").lower().split()[j:] for j in range(k)])) for i, t in items if t}
    bags = {i: b for i, b in bags.items() if b}
    df = Counter(s for b in bags.values() for s in b)
    weight = lambda s: np.log1p(len(bags) / max(df[s], 1))
    found = {}
    for d, text in docs:
        w = (text or "").lower().split()
        for i, bag in bags.items():
            size = min(sum(bag.values()) + k - 1, len(w))
            for a in range(len(w) - size + 1):
                own = Counter(zip(*[w[a + j:a + size] for j in range(k)]))
                if not own.keys() & bag.keys():
                    continue
                both = sum(weight(s) * min(n, bag[s]) for s, n in own.items())
                sim = both / (sum(weight(s) * n for x in (own, bag) for s, n in x.items()) - both)
                if sim >= least and sim > found.get((d, i), (0, 0))[0] + 1e-9:
                    found[d, i] = (sim, a)
    return found


def test_decontamination_equals_brute_force(spark):
    rng = random.Random(5)
    words = [f"w{i}" for i in range(400)]
    items = [(i, " ".join(rng.choices(words, k=rng.choice([12, 20, 40])))) for i in range(12)] + [(90, None), (91, "too short")]
    items.append((12, items[3][1]))
    docs = []
    for d in range(60):
        body = rng.choices(words, k=rng.randint(0, 150))
        if d % 2:
            w = rng.choice(items[:12])[1].split()
            if d % 3 == 0:  # near copies: words changed at the ends and, in long ones, within
                w[rng.randrange(len(w))] = "changed"
            if d % 5 == 0:
                w = w[1:]
            at = rng.randint(0, len(body))
            body[at:at] = [x.upper() for x in w]
        docs.append((d, " ".join(body)))
    docs.append((60, " ".join(items[0][1].split()[:-1])))  # shorter than the item
    bench = spark.createDataFrame([(*i, "x") for i in items], "item_id long, text string, doc_id string")
    got = {(r["doc_id"], r["item_id"]): (r["similarity"], r["start_word"]) for r in decontaminate.contaminated(
        spark.createDataFrame(docs, "doc_id long, text string").repartition(3), bench).collect()}
    want = brute_matches(docs, items)
    assert got.keys() == want.keys() and len(got) > 10
    assert all(abs(got[k][0] - want[k][0]) < 1e-4 and got[k][1] == want[k][1] for k in got)


def test_decontamination_of_items_with_a_shared_prompt(spark):
    rng = random.Random(11)
    words = [f"w{i}" for i in range(3000)]
    prompt, items, docs = rng.choices(words, k=200), [], []
    for i in range(120):  # the prompt stays, and the end of what is the item's own is another
        own = rng.choices(words, k=12)
        items.append((i, " ".join(prompt + own)))
        docs.append((i, " ".join(prompt + own[:-4] + rng.choices(words, k=4))))
    got = {(r["doc_id"], r["item_id"]): (r["similarity"], r["start_word"]) for r in decontaminate.contaminated(
        spark.createDataFrame(docs, "doc_id long, text string").repartition(4),
        spark.createDataFrame(items, "item_id long, text string")).collect()}
    assert got.keys() == {(i, i) for i in range(120)}
    want = brute_matches(docs[::12], items)
    assert len(want) == 10 and all(abs(got[k][0] - want[k][0]) < 1e-4 and got[k][1] == want[k][1] for k in want)


def test_radii_hold_what_reaches_the_threshold():
    """Of windows at or a little above the threshold, at least 99 in 100 lie within their item's radius,
    whichever words are changed and however uneven the weights; all within it are found."""
    rng = np.random.default_rng(3)
    words = [f"w{i}" for i in range(5000)]
    prompt = list(rng.choice(words, 60))
    items = [(i, " ".join((prompt if i % 2 else []) + list(rng.choice(words, int(rng.integers(12, 60)))))) for i in range(60)]
    df = Counter(s for _, t in items for s in set(zip(*[t.split()[j:] for j in range(5)])))
    rows = []
    for i, t in items:
        words_ = decontaminate.Words(*decontaminate.texts(pa.array([t], pa.large_string())), decontaminate.byte_table("space"))
        grams, _ = words_.grams(5)
        names = list(zip(*[t.split()[j:] for j in range(5)]))
        of = dict(zip(grams.tolist(), names))
        rows.append((i, t, np.array([df[of[g]] for g in np.unique(grams).tolist()])))
    index = decontaminate._Items(rows, len(items), 5, 0.8)
    near = within = 0
    for i, t in items:
        for _ in range(200):
            w = t.split()
            first = 0 if rng.random() < 0.5 else len(w) - int(rng.integers(3, 12))
            for j in range(int(rng.integers(1, 7))):
                w[(first + j) % len(w)] = str(rng.choice(words))
            grams, _ = decontaminate.Words(*decontaminate.texts(pa.array([" ".join(w)], pa.large_string())),
                                           decontaminate.byte_table("space")).grams(5)
            at = np.searchsorted(index.known, grams)
            at = np.where(index.known[np.minimum(at, len(index.known) - 1)] == grams, at, -1)
            weight = np.where(at >= 0, index.weight[at], index.rare)
            if 0.8 <= index._similarity(i, at, float(weight.sum())) < 0.86:
                near += 1
                finger = index.fingerprint(grams, weight)[None]
                hit = int((finger[0] != index.finger[i]).sum()) <= index.radius[i]
                within += hit
                assert hit == (i in [x[1] for x in index._within(finger, index.size[i])])
    assert near > 300 and within >= 0.99 * near


def test_text_ids_of_items(spark):
    text = " ".join(f"x{i}" for i in range(30))
    bench = spark.createDataFrame([("item-a", text)], "item_id string, text string")
    docs = spark.createDataFrame([("doc-1", "before " + text, "q"), (None, text, "q"), ("doc-2", "other", "q")], "doc_id string, text string, item string")
    got = {(r["doc_id"], r["item_id"], r["start_word"]) for r in decontaminate.contaminated(docs, bench).collect()}
    assert got == {("doc-1", "item-a", 1), (None, "item-a", 0)}
    assert [r["doc_id"] for r in decontaminate.decontaminate(docs, bench).collect()] == ["doc-2"]


def test_item_blocks_and_awkward_tables(spark, monkeypatch):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    bench = spark.read.parquet(f"{SF}/benchmark.parquet")
    whole = sorted(map(tuple, decontaminate.contaminated(docs, bench).collect()))
    monkeypatch.setattr(decontaminate, "ITEM_BLOCK", 7)
    parts = {r[:2] for r in map(tuple, decontaminate.contaminated(docs, bench).collect())}
    assert parts == {r[:2] for r in whole} and whole
    left = decontaminate.decontaminate(docs, bench)
    assert left.columns == docs.columns and left.count() == docs.count() - len({r[0] for r in whole})
    odd = awkward(spark)
    assert decontaminate.contaminated(odd, bench).count() == 0 and decontaminate.decontaminate(odd, bench).count() == odd.count()
    assert decontaminate.contaminated(empty(spark), bench).count() == 0
    assert decontaminate.contaminated(docs, bench.limit(0)).count() == 0


def test_item_blocks_give_equal_similarities(spark, monkeypatch):
    rng = random.Random(4)
    words = [f"w{i}" for i in range(900)]
    prompt, body = rng.choices(words, k=20), [rng.choices(words, k=20) for _ in range(12)]
    bench = spark.createDataFrame([(i, " ".join((prompt if i % 3 else []) + b)) for i, b in enumerate(body)], "item_id long, text string")
    docs = spark.createDataFrame([(i, " ".join(prompt + b[:-2])) for i, b in enumerate(body)], "doc_id long, text string")
    found = lambda: {(r["doc_id"], r["item_id"]): round(r["similarity"], 9) for r in decontaminate.contaminated(docs, bench).collect()}
    whole = found()
    monkeypatch.setattr(decontaminate, "ITEM_BLOCK", 5)
    assert found() == whole and len(whole) >= 8


# 5 -------------------------------------------------------------------------------------
def test_mix_targets_and_reruns(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").withColumn(
        "source", F.when(F.col("doc_id") % 3 == 0, "hot").when(F.col("doc_id") % 50 == 1, None).otherwise(F.col("source")))
    out = fair_mix.mix(docs)
    rows = out.collect()
    again = fair_mix.mix(docs.repartition(7)).collect()
    assert sorted(map(repr, rows)) == sorted(map(repr, again))
    by = defaultdict(list)
    for r in rows:
        by[r["source"]].append(r)
    order = sorted((s for s in by if s is not None), key=lambda s: s.encode()) + ([None] if None in by else [])
    size = {s: sum(r["size"] for r in by[s]) for s in by}
    left, target, budget = list(order), {}, 1.5 * sum(size.values())
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(order)}
    while True:
        per = (budget - sum(target.values())) / sum(weight[s] for s in left)
        over = [s for s in left if weight[s] * per > 2 * size[s]]
        if not over:
            break
        target.update({s: 2 * size[s] for s in over})
        left = [s for s in left if s not in over]
    target.update({s: weight[s] * per for s in left})
    biggest = max(r["size"] for r in rows)
    for s in by:
        assert all(abs(r["target"] - target[s]) < 1e-6 * target[s] and r["source_size"] == size[s] for r in by[s])
        assert abs(sum(r["taken"] for r in by[s]) - target[s]) <= biggest
        assert all(0 <= r["taken"] <= 2 * r["size"] for r in by[s])
    mixed = fair_mix.mix_documents(docs)
    assert mixed.columns == docs.columns and mixed.count() == sum(r["copies"] for r in rows)


def test_mix_awkward(spark):
    rows = fair_mix.mix(awkward(spark)).collect()
    assert len(rows) == awkward(spark).count() and all(r["taken"] <= 2 * r["size"] for r in rows)
    assert fair_mix.mix(empty(spark)).count() == 0 and fair_mix.mix_documents(empty(spark)).count() == 0


# 6 -------------------------------------------------------------------------------------
def enumerated(e, trans):
    """Marginals by summing over all label sequences."""
    from itertools import product
    p = np.zeros_like(e)
    for seq in product(range(e.shape[1]), repeat=len(e)):
        w = np.exp(sum(e[t, y] for t, y in enumerate(seq)) + sum(trans[a, b] for a, b in zip((*seq,), seq[1:])))
        for t, y in enumerate(seq):
            p[t, y] += w
    return p / p.sum(axis=1, keepdims=True)


def test_forward_backward_is_exact(monkeypatch):
    rng = np.random.default_rng(3)
    monkeypatch.setattr(lang_crf, "BLOCK", 3)
    lengths = [0, 1, 7, 3, 6, 0, 5]
    first = np.concatenate([[0], np.cumsum(lengths)])
    e, trans = rng.normal(size=(first[-1], 3)), rng.normal(size=(3, 3))
    start = np.log(np.exp(trans - trans.max()).sum(axis=0))  # the chain enters from a uniform state
    got = lang_crf.marginals(e, first, trans)
    for a, b in zip(first[:-1], first[1:]):
        if b > a:
            own = e[a:b].copy()
            own[0] += start
            assert np.allclose(got[a:b], enumerated(own, trans), atol=1e-9)


def test_language_held_out_accuracy(spark):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    j = lang_crf.identify(docs).join(docs.select("doc_id", "lang", F.length("text").alias("chars")), "doc_id").filter(
        "held_out and lang is not null")
    right, n = j.agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("double")), F.count("*")).first()
    assert n > 1000 and right > 0.97


def test_code_switched_words():
    langs = {"xx": ["kata", "keto", "kimu", "kola", "kuri", "kasa"], "yy": ["zenf", "zirp", "zomp", "zurl", "zask", "zelt"]}
    rng = random.Random(1)
    rows = [(x, " ".join(rng.choices(w, k=200))) for x, w in langs.items() for _ in range(20)]
    model = lang_crf.fit(rows)
    p, first = lang_crf.Labeller(model).label(pa.array(["kata keto kimu zenf zirp zomp zurl kola", "123 !", None]))
    assert [model.langs[i] for i in p.argmax(axis=1)] == ["xx"] * 3 + ["yy"] * 4 + ["xx"]
    assert np.diff(first).tolist() == [8, 0, 0]


def test_short_and_unsegmented_rows_teach():
    rng = random.Random(3)
    letters = {"aa": "abcdef", "bb": "ghijkl", "cc": "mnopqr", "dd": "stuvwx"}
    letters["zh"], letters["ja"] = ("".join(chr(c + i) for i in range(60)) for c in (0x4E00, 0x3041))
    write = {x: lambda x=x, n=3: " ".join("".join(rng.choices(letters[x], k=5)) for _ in range(n)) for x in ("aa", "bb", "cc", "dd")}
    write |= {x: lambda x=x: "".join(rng.choices(letters[x], k=200)) for x in ("zh", "ja")}  # one run of letters
    model = lang_crf.fit([(x, w()) for x, w in write.items() for _ in range(40)] + [("none", "12 34")])
    assert model.langs == sorted(write)
    want = [x for x in write for _ in range(10)]
    p, first = lang_crf.Labeller(model).label(pa.array([write[x]() for x in want]))
    mean = np.array([p[a:b].mean(axis=0) for a, b in zip(first[:-1], first[1:])])
    assert [model.langs[i] for i in mean.argmax(axis=1)] == want and mean.max(axis=1).min() > 0.5
    assert np.diff(first)[-1] == 7  # 600 bytes
    assert lang_crf.fit([("aa", "12 34"), ("bb", "")]).langs == []
    late = [("aa", write["aa"](n=150) + " " + write["dd"](n=900)), ("bb", write["bb"](n=150) + " " + write["cc"](n=900))] * 4
    p, _ = lang_crf.Labeller(model := lang_crf.fit(late)).label(pa.array([write["cc"](n=20)]))
    assert model.langs[p.mean(axis=0).argmax()] == "bb" and p.mean(axis=0).max() > 0.6


def test_language_awkward(spark):
    got = {r["doc_id"]: r for r in lang_crf.identify(awkward(spark)).collect()}
    assert got[1]["lang_pred"] == got[2]["lang_pred"] == got[3]["lang_pred"] == "und" and got[1]["score"] == 0
    assert got[7]["lang_pred"] in ("en", "de", "fr") and 0 <= got[7]["score"] <= 1 and not got[None]["held_out"]
    assert lang_crf.identify(empty(spark)).count() == 0
    kept = lang_crf.reject_unidentified(awkward(spark))
    assert kept.columns == awkward(spark).columns and kept.filter("doc_id in (1, 2, 3)").count() == 0


# 7 -------------------------------------------------------------------------------------
def test_warc_round_trip(spark, tmp_path):
    pages = [(1, "http://a/", "x\r\n\r\nWARC/1.1\r\nContent-Length: 5\r\n\r\n"), (2, "http://b/", "same"), (3, "http://c/\r\nx", "same"),
             (4, None, None), (5, "http://e/", ""), (6, "http://f/", "é\U0001f600\r\n"), (7, "http://g/", "solo"),
             (7, "http://g/", "solo"), (None, "http://h/", "same"), (9, "http://i/", "y" * 300_000)]
    df = spark.createDataFrame([(*p, "z") for p in pages], "page_id long, url string, html string, digest string")
    for least in (0, 5):
        path = str(tmp_path / f"w{least}")
        warc.write_archives(df.repartition(3), path, revisit_bytes=least)
        captures = warc.read_captures(spark, path)
        rows = captures.collect()
        assert len(rows) == len(pages) and all(r["request"] and r["response"] and r["metadata"] for r in rows)
        assert Counter(bytes(r["response"]["payload"]).decode() for r in rows if r["response"]["type"] == "response") == Counter(
            p[2] or "" for p in pages if role(p, pages, least) == "response")
        got = sorted(map(repr, (tuple(r) for r in warc.page_digests(captures).collect())))
        want = []
        for p in pages:
            data = (p[2] or "").encode()
            kind = role(p, pages, least)
            top = max((q[0] for q in pages if (q[2] or "") == (p[2] or "") and q[0] is not None), default=None)
            want.append((p[0], len(data), base64.b32encode(hashlib.sha1(data).digest()).decode(), kind,
                         top if kind == "revisit" else None))
        assert got == sorted(map(repr, want))
    none = str(tmp_path / "none")
    warc.write_archives(df.limit(0), none)
    assert warc.read_captures(spark, none).count() == 0


def role(p, pages, least):
    same = [q for q in pages if (q[2] or "") == (p[2] or "")]
    top = max((q[0] for q in same if q[0] is not None), default=None)
    return "revisit" if len(same) > 1 and len((p[2] or "").encode()) >= least and p[0] != top else "response"


def test_warc_reads_plain_and_multi_member_files():
    import gzip
    one = b"WARC/1.1\r\nWARC-Type: request\r\nContent-Length: 3\r\n\r\nabc\r\n\r\n"
    for data in (one + one, gzip.compress(one) + gzip.compress(one)):
        assert [b for _, b in warc.records(warc._inflated(data))] == [b"abc", b"abc"]


# 8 -------------------------------------------------------------------------------------
def brute_components(rows, k, percent):
    sets = {}
    for i, t in rows:
        w = (t or "").encode().lower().split()
        sets[i] = {tuple(w[j:j + k]) for j in range(max(1, len(w) - k + 1))} if w else set()
    top = {i: i for i in sets}

    def find(x):
        while top[x] != x:
            x = top[x]
        return x
    ids = sorted(sets)
    for n, a in enumerate(ids):
        for b in ids[n + 1:]:
            both = len(sets[a] & sets[b])
            if both and 100 * both >= percent * len(sets[a] | sets[b]):
                x, y = sorted((find(a), find(b)))
                top[y] = x
    return {i: (len(sets[i]), find(i)) for i in ids}


@pytest.mark.parametrize("k, percent", [(3, 85), (5, 80)])
def test_near_duplicates_equal_brute_force(spark, k, percent):
    rng = random.Random(k)
    words = [f"w{i}" for i in range(300)]
    rows = []
    for family in range(6):
        base = rng.choices(words, k=rng.choice([4, 30, 120]))
        for _ in range(25):  # near copies at all distances: many pairs about the threshold
            w = list(base)
            for _ in range(rng.randint(0, 6)):
                w[rng.randrange(len(w))] = rng.choice(words)
            rows.append((len(rows), " ".join(w).upper() if rng.random() < 0.3 else " ".join(w)))
    rows += [(len(rows) + j, rows[0][1]) for j in range(40)]  # exact copies
    rows += [(1000, "short"), (1001, "SHORT"), (1002, ""), (1003, None), (1004, " \t")]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in near_dedup.near_duplicates(
        df, words=k, percent=percent).collect()}
    assert got == brute_components(rows, k, percent)


def test_near_duplicates_awkward(spark):
    out = near_dedup.near_duplicates(awkward(spark)).collect()
    assert len(out) == awkward(spark).count()
    by = defaultdict(set)
    for r in out:
        by[r["doc_id"]].add((r["component_id"], r["kept"]))
    assert by[1] == {(1, True)} and by[8] == {(7, False)} and by[4] == {(4, True)} and by[None] == {(None, True)}
    assert near_dedup.near_duplicates(empty(spark)).count() == 0
    kept = near_dedup.drop_near_duplicates(awkward(spark))
    assert kept.columns == awkward(spark).columns and kept.filter("doc_id = 8").count() == 0


def test_densified_registers_keep_similarity():
    rng = np.random.default_rng(0)
    same = []
    for _ in range(40):
        common = rng.integers(0, 2 ** 63, 18, dtype=np.uint64)
        sets = [np.unique(np.append(common, rng.integers(0, 2 ** 63, 1, dtype=np.uint64)) * np.uint64(2)) for _ in range(2)]
        reg, full = np.zeros((2, near_dedup.BINS), np.uint64), np.zeros((2, near_dedup.BINS), bool)
        for i, s in enumerate(sets):
            bins = (s >> np.uint64(56)).astype(int)
            for b, v in zip(bins[::-1], s[::-1]):
                reg[i, b], full[i, b] = v, True
        near_dedup._densify(reg, full)
        same.append((reg[0] == reg[1]).mean())
    assert abs(np.mean(same) - 18 / 20) < 0.05


def test_bands_hold_the_miss_rate():
    assert near_dedup._bands(85) == (32, 8)
    for percent in range(1, 101):
        bands, rows = near_dedup._bands(percent)
        assert (1 - (percent / 100) ** rows) ** bands <= 4e-5
    text = " ".join(f"w{i}" for i in range(300))
    sketch = next(near_dedup._sketch_batches([pa.record_batch(
        [pa.array([1]), pa.array([1]), pa.array([text])], ["id", "hash", "text"])], 5, *near_dedup._bands(80)))
    assert (1 - 0.8 ** 8) ** len(set(sketch.column("bands")[0].as_py())) <= 4e-5


def test_components_of_paths_and_stars(spark):
    rng = random.Random(2)
    edges = [(i, i + 1) for i in range(0, 60)] + [(100, i) for i in range(101, 180)] + [(200, 200), (301, 300), (300, 301)]
    rng.shuffle(edges)
    got = {r["node"]: r["component"] for r in components.components(
        spark.createDataFrame(edges, "x long, y long"), "x", "y").collect()}
    want = {i: 0 for i in range(61)} | {i: 100 for i in range(100, 180)} | {300: 300, 301: 300}
    assert got == want


# 9 -------------------------------------------------------------------------------------
def test_quality_held_out_accuracy(spark):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.1/{t}.parquet") for t in ("documents", "labels"))
    out = quality_nbsvm.score_quality(docs, labels)
    rows = out.join(labels, "doc_id").filter("held_out").groupBy("quality").agg(
        F.avg((F.col("predicted") == F.col("quality")).cast("double")).alias("right"), F.count("*").alias("n")).collect()
    assert all(r["right"] > 0.93 and r["n"] > 100 for r in rows) and len(rows) == 2


def test_quality_awkward(spark):
    docs = awkward(spark)
    labels = spark.createDataFrame([(4, 1, 0), (5, 0, 0), (7, 1, 0), (8, 0, None), (8, 1, 0), (None, 1, 0), (9, None, 0)],
                                   "doc_id long, quality int, text int")
    out = quality_nbsvm.score_quality(docs, labels).collect()
    assert len(out) == docs.count() and all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.7) for r in out)
    alone = quality_nbsvm.score_quality(docs, labels.filter("quality = 1")).collect()
    assert len({r["score"] for r in alone}) == 1
    assert {r["score"] for r in quality_nbsvm.score_quality(docs, labels.limit(0)).collect()} == {0.5}
    assert quality_nbsvm.score_quality(empty(spark), labels).count() == 0


# 10 ------------------------------------------------------------------------------------
def brute_rules(text):
    t = text or ""
    words = [w.decode() for w in t.encode().split()]
    windows = Counter(zip(words, words[1:], words[2:]))
    hit = set()
    for i, w in enumerate(zip(words, words[1:], words[2:])):
        if windows[w] > 1:
            hit |= {i, i + 1, i + 2}
    lines = [x for x in t.split("\n") if x.encode().split()]
    return (len(words), sum(map(len, words)), sum(t.count(c) for c in "#*$%&|<>"), len(lines),
            len(lines) - len(set(lines)), len(hit))


def test_rules_equal_brute_force(spark):
    rng = random.Random(4)
    made = [(100 + i, " ".join(rng.choices(["a", "b", "c\n", "#x", "é|", "long" * 9], k=rng.randint(1, 80))), "en", "a") for i in range(60)]
    docs = awkward(spark, made).drop("n", "size")
    rows = quality_rules.ledger(docs.select("doc_id", "text", "lang")).collect()
    texts = defaultdict(set)
    for r in docs.collect():
        texts[r["doc_id"]].add(brute_rules(r["text"]))
    for r in rows:
        m = tuple(r[c] for c in ("n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words"))
        assert m in texts[r["doc_id"]]
        assert bool(r["fail_bits"] & 1) == (m[0] < 50) and bool(r["fail_bits"] & 2) == (100 * m[5] > 50 * m[0])
    assert quality_rules.ledger(empty(spark).select("doc_id", "text")).count() == 0


def test_ablations_equal_counts(spark):
    ledger = quality_rules.ledger(spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text"))
    bits = [r["fail_bits"] for r in ledger.collect()]
    for r in quality_rules.ablations(ledger).collect():
        names = quality_rules.POLICIES[r["policy"]]
        all_, without = quality_rules.mask(names), quality_rules.mask([n for n in names if n != r["rule"]])
        one = quality_rules.mask([r["rule"]])
        assert (r["n_failed"], r["n_kept"], r["n_kept_without"]) == (
            sum(bool(b & one) for b in bits), sum(not b & all_ for b in bits), sum(not b & without for b in bits))


@pytest.mark.parametrize("name", ["op1_chat_format", "op10_quality_rules"])
def test_native_queries_run_no_python(spark, name):
    plan = queries.QUERIES[name](spark, SF)._jdf.queryExecution().toString()
    assert not any(x in plan for x in ("Python", "Arrow", "Pandas"))


def test_schema_of_awkward_types(spark):
    docs = awkward(spark).withColumn("d", F.lit("1.5").cast(T.DecimalType(10, 2))).withColumn("a", F.array(F.lit(1)))
    assert lang_crf.reject_unidentified(docs).schema.names == docs.schema.names


def shingled(n, extra=""):
    return " ".join(f"v{i}" for i in range(n)) + extra


def test_null_ids_link_like_others(spark):
    rows = [(None, shingled(300)), (None, shingled(300, " one")), (5, shingled(300, " one two")), (None, "other text of a null id")]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = sorted(((r["doc_id"], r["component_id"], r["kept"]) for r in near_dedup.near_duplicates(df).collect()), key=repr)
    assert got == sorted([(None, 5, False), (None, 5, False), (5, 5, True), (None, None, True)], key=repr)
    kept = near_dedup.drop_near_duplicates(df).collect()
    assert sorted((r["doc_id"] or -1 for r in kept)) == [-1, 5]


def test_one_row_of_each_component_stays(spark):
    text = shingled(60)
    rows = [(7, text, "a"), (7, text, "b"), (7, text, "a"), (7, shingled(60, " x"), "a"), (9, text.upper(), "a"), (None, text, "a"),
            (None, "lonely words here", "a"), (None, "lonely words here", "c"), (3, "", "a"), (3, "", "a"), (4, None, "a"), (8, "alone too", "a")]
    df = spark.createDataFrame([(*r, 1, "h") for r in rows], "id long, text string, hash string, gone_id int, GONE_HASH string").repartition(4)
    kept = near_dedup.drop_near_duplicates(df, id_col="id")
    assert kept.columns == df.columns
    got = Counter((r["id"], (r["text"] or "")[:6]) for r in kept.collect())
    assert got == {(7, "v0 v1 "): 1, (None, "lonely"): 1, (3, ""): 2, (4, ""): 1, (8, "alone "): 1}


def test_settled_buckets_equal_brute_force(spark, monkeypatch):
    """Many documents that are all alike, a little below and above the threshold."""
    monkeypatch.setattr(near_dedup, "STAR_ROUNDS", 1)
    rng = random.Random(12)
    base = [f"b{i}" for i in range(60)]
    rows = []
    for d in range(70):
        w = list(base)
        for _ in range(rng.randint(0, 4)):
            w[rng.randrange(60)] = f"x{rng.randint(0, 3)}"
        rows.append((d, " ".join(w)))
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in near_dedup.near_duplicates(df, words=3, percent=85).collect()}
    assert got == brute_components(rows, 3, 85)


def test_ledger_with_columns_called_like_measurements(spark):
    docs = spark.createDataFrame([(1, "some words here", 99, 5, "k")], "doc_id long, text string, n_words long, Fail_bits int, other string")
    row = quality_rules.ledger(docs).first()
    assert (row["n_words"], row["fail_bits"], row["other"]) == (3, 1, "k")


def test_tokens_of_text_ids(spark, tmp_path):
    docs = spark.createDataFrame([("b", "two words", 1), ("a", None, 1), (None, "x", 1), ("b", "two words", 1)], "doc_id string, text string, id int")
    token_codes.write_tokens(docs, str(tmp_path / "t"), queries.tokenizer_path())
    got = token_codes.read_documents(spark, str(tmp_path / "t")).orderBy("start").collect()
    ids = library_ids(["x", None, "two words"])
    assert [(r["doc_id"], r["n_tokens"]) for r in got] == [(None, len(ids[0])), ("a", 1), ("b", len(ids[2])), ("b", len(ids[2]))]
