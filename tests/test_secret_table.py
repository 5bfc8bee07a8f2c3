"""Masking by a table of secrets against the fold over its list."""
import random

import numpy as np
import pyarrow as pa

from tallyframe.functions.text import mask_secret_literal
from tallyframe.operators import secret_table as S


def fold(text, secrets):
    for _, s in sorted(x for x in secrets if x[1]):
        text = text.replace(s, mask_secret_literal(s)) if text is not None else None
    return text


def check(spark, texts, secrets):
    docs = spark.createDataFrame([(i, t, "k") for i, t in enumerate(texts)], "pos int, text string, secret string").repartition(3)
    table = spark.createDataFrame(secrets, "pos int, secret string").repartition(2)
    out = S.mask_by_table(docs, table)
    assert out.columns == docs.columns
    got = {r["pos"]: r["text"] for r in out.collect()}
    assert got == {i: fold(t, secrets) for i, t in enumerate(texts)}


def test_rolling_hashes_tell_windows_apart():
    data = np.frombuffer(("abcabcabd" * 50 + "xyz").encode(), np.uint8)
    for length in (1, 2, 3, 7, 8, 64, 100):
        hashes = S.rolling_hashes(data, length)
        raw = data.tobytes()
        of = {}
        for i, h in enumerate(hashes.tolist()):
            assert of.setdefault(h, raw[i:i + length]) == raw[i:i + length]
        assert len(set(raw[i:i + length] for i in range(len(hashes)))) == len(of)
        assert S.rolling_hashes(data[5:5 + length], length)[0] == hashes[5]
    assert len(S.rolling_hashes(data[:3], 4)) == 0


def test_masks_equal_the_fold(spark):
    texts = ["my password is hunter2, hunter22 and passwordhunter2", "é😀é secret über", "nothing", "", None, "my password", "pass" * 40, "aXbXc"]
    secrets = [(3, "hunter2"), (1, "password"), (2, "hunter22"), (4, "é😀"), (5, "über"), (6, None), (7, ""), (8, "passpass"), (9, "X"), (9, "my password")]
    check(spark, texts, secrets)


def test_secrets_that_masks_bring_about(spark):
    texts = ["token=abcde", "t***n is no token", "xax", "ab xx", "plain"]
    check(spark, texts, [(1, "token"), (2, "t***n"), (3, "n=a"), (4, "***"), (5, "x"), (6, "xx"), (7, "xxa"), (8, "bb")])


def test_many_random_secrets(spark):
    rng = random.Random(5)
    word = lambda: "".join(rng.choice("abcdéf") for _ in range(rng.randint(2, 9)))
    secrets = [(rng.randint(0, 50), word()) for _ in range(400)]
    check(spark, [" ".join(word() for _ in range(rng.randint(0, 80))) for _ in range(60)], secrets)


def test_empty_tables(spark):
    check(spark, ["text"], [(1, None)])
    docs = spark.createDataFrame([], "pos int, text string")
    assert S.mask_by_table(docs, spark.createDataFrame([(1, "a")], "pos int, secret string")).count() == 0


def test_filter_grows_with_the_list(spark):
    known = spark.range(300_000).selectExpr("0 as pos", "concat('Customer#', lpad(id, 9, '0')) as secret").unionByName(
        spark.createDataFrame([(1, "hunter2")], "pos int, secret string"))
    known = known.mapInArrow(S._hashed, "pos int, secret string, size bigint, hash bigint").cache()
    filters = S._filter_sizes({18: 300_000, 7: 1})
    bitmap = S._bitmap(known, filters)
    rng = np.random.default_rng(3)
    text = rng.integers(97, 123, 400_000).astype(np.uint8).tobytes().decode() + " Customer#000012345 hunter2"
    batch = pa.RecordBatch.from_arrays([pa.array([b"t"]), pa.array([text])], ["key", "text"])
    found = [x["size"] for out in S._windows([batch], filters, bitmap) for row in out.column("found").to_pylist() for x in row]
    assert 1 <= found.count(7) < 400 and 1 <= found.count(18) < 400  # of 400,000 windows each
    assert sum(n for _, n in S._filter_sizes({18: 1 << 30, 5: 9}).values()) <= S.MOST_FILTER_BITS
