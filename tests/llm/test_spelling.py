"""Operator 12 against comparisons of all pairs, and on awkward tables."""
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from tallyframe.llm import queries, spelling


def near(a, b):
    """Exactly one inserted, deleted or replaced letter."""
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return len(a) + 1 == len(b) and any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def brute(counts, factor=5):
    out = {}
    for w, n in counts.items():
        others = [(-m, v) for v, m in counts.items() if near(w, v)]
        top = min(others, default=None)
        form = top[1] if top and -top[0] >= factor * n else None
        out[w] = (form, n, len(others), counts[form] if form else None)
    rows = []
    for w, (form, n, n_near, form_n) in out.items():
        root = w
        while out[root][0]:
            root = out[root][0]
        rows.append((w, form, root, n, n_near, form_n))
    return sorted(rows)


def vocabulary_of(rng, size):
    letters = "abcdefghijklmnopqrstuvwxyzàéÿ"
    seeds = ["".join(rng.choice(letters) for _ in range(rng.randint(5, 12))) for _ in range(size)]
    out = Counter()
    for w in seeds:
        out[w] += rng.randint(5, 4000)
        for _ in range(rng.randint(0, 4)):
            i, kind = rng.randrange(len(w)), rng.randrange(4)
            w = (w[:i] + rng.choice(letters) + w[i + (kind > 0):] if kind < 2 else w[:i] + w[i + 1:]
                 if kind == 2 else w[:i] + w[i:][::-1])
            out[w] += rng.choice([5, 6, 25, 100, 500])
    return {w: n for w, n in out.items() if w}


def test_variants_equal_all_pairs(spark):
    counts = vocabulary_of(random.Random(4), 300)
    counts |= {"a" * 4000 + "b": 7, "a" * 4000 + "c": 70, "a" * 4000: 700, "aaaaaa": 5, "aaaaaaa": 5, "aaaaaaaa": 5}
    df = spark.createDataFrame([(w, n, "x") for w, n in counts.items()], "word string, n long, form string").repartition(5)
    assert sorted(tuple(r) for r in spelling.variants(df).collect()) == brute(counts)


def test_large_cells_are_split(spark, monkeypatch):
    """Many words of one cell: more than one block, no pair lost or met twice."""
    rng = random.Random(8)
    counts = {"".join(rng.choice("abc") for _ in range(8)): rng.randint(5, 500) for _ in range(1500)}
    df = spark.createDataFrame(list(counts.items()), "word string, n long")
    monkeypatch.setattr(spelling, "BLOCK_LETTERS", 200)
    pairs = [tuple(r) for r in spelling.near_words(df).select("a", "b").collect()]
    both = {frozenset(p) for p in pairs}
    words = list(counts)
    assert len(both) == len(pairs)
    assert both == {frozenset((a, b)) for i, a in enumerate(words) for b in words[i + 1:] if near(a, b)}


def test_moves_lead_to_every_near_word():
    moves = spelling._moves()
    known = set(moves) | {tuple(-x for x in m) for m in moves}
    n = len(spelling._G)
    for g in range(n):
        for h in range(n):
            replaced = tuple((i == g) - (i == h) for i in range(n))
            assert replaced in known
    assert len(set(moves)) == len(moves) == 1 + n + n * (n - 1) // 2


def test_verification_of_edits():
    letters = lambda w: np.array([[ord(c) for c in w]])
    for a, b in [("abcd", "abcd"), ("abcd", "abce"), ("abcd", "badc"), ("aaaa", "aaab")]:
        assert spelling._one_replaced(letters(a), letters(b))[0] == near(a, b)
    for a, b in [("abc", "abcd"), ("abc", "xabc"), ("abc", "acbc"), ("abc", "cbad"), ("aab", "aaab"), ("abc", "bcda")]:
        assert spelling._one_inserted(letters(a), letters(b))[0] == near(a, b)


TEXTS = ["Tomorrow tomorrow TOMORROW tomorow ÀÉÿabcd àÉÿabcd", "x" * 5000 + " " + "y" * 30, "", None, "été2êtres_déjàvu", "1 2 3",
         "a b c dd eeeeee"]


def test_query_on_awkward_documents(spark, tmp_path):
    rng = random.Random(2)
    words = [w for w in vocabulary_of(rng, 60)]
    rows = [(i, " ".join(rng.choice(words) for _ in range(60)), "w", 3) for i in range(80)]
    rows += [(1000 + i, t, "w", 3) for i, t in enumerate(TEXTS) for _ in range(6)] + [(None, TEXTS[0], "w", 3)]
    schema = "doc_id long, text string, word string, n int"
    spark.createDataFrame(rows, schema).repartition(4).write.parquet(str(tmp_path / "documents.parquet"))
    counts = Counter()
    for key, text, *_ in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(c.lower() if c.isascii() else c for c in run)
            h = zlib.crc32(f"{'' if key is None else key}:{run}".encode())
            if h % 199 == 0:
                at = h % len(run)
                run = run[:at] + run[at + 1:]
            counts[run] += 1
    counts = {w: n for w, n in counts.items() if len(w) >= 6 and n >= 5}
    got = sorted(tuple(r) for r in queries.op12_spelling_variants(spark, str(tmp_path)).collect())
    assert got == brute(counts)


def test_empty_tables(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert spelling.variants(spelling.vocabulary(spelling.runs(docs))).count() == 0


def test_factor_must_separate(spark):
    with pytest.raises(ValueError):
        spelling.variants(spark.createDataFrame([], "word string, n long"), factor=1)
