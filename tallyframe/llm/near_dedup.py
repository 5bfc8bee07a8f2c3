"""Near-duplicate documents: one-permutation MinHash, banded buckets, star edges (operator 8).

1. One pass over the texts hashes each document's distinct word shingles once.  The top bits of
   a hash name its bin, the smallest hash of a bin is its register, and empty bins copy the
   register of a bin drawn by a 2-universal hash of (bin, attempt): optimal densification.
2. Documents with the same shingle set form a class (128-bit digest of the set), so thousands of
   exact copies count as one node from here on.
3. Registers are hashed by band into buckets.  In a bucket, the members are compared with one
   centre, a star: as many pairs as members.  After each star round the linked members are
   components, and only buckets that still hold several components go on.
4. What stars have left open is settled exactly: each member outside a bucket's largest
   component is compared with the bucket's members of other components.
5. Every pair is confirmed on the full shingle sets; two exact bounds (set sizes, and the number
   of bins whose smallest hashes differ) discard hopeless pairs first.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .components import components
from .hashing import Words, byte_table, mix64, slices, texts
from .tables import free_name, written

#: A pair at the similarity asked for misses every bucket with at most this probability; ``_bands``
#: derives the bands from it: 32 of 8 registers at 0.85 (3.8e-5), 56 of 8 at 0.80 (3.4e-5).
MISS = 4e-5
#: Least bands and most registers of a band; bands up to which more registers a band are preferred.
BANDS, ROWS, MOST_BANDS = 32, 8, 64
BINS = BANDS * ROWS
#: Bins and bits a bin of the check words, which discard most pairs without reading their sets.
CHECK_BINS, CHECK_BITS = 1024, 4
#: Star rounds with different centres before what is left is settled exactly.
STAR_ROUNDS = 2
#: Parts that the members of a bucket are dealt into when it is settled.
SALTS = 8


def _sets(column: pa.Array, k: int) -> Iterator[np.ndarray]:
    """Sorted distinct shingle hashes of each text; a text of fewer than k words has one."""
    words = Words(*texts(column), byte_table("space"))
    grams, _ = words.grams(k)
    for lo, hi in zip(words.first[:-1], words.first[1:]):
        if hi - lo >= k:
            yield np.unique(grams[lo:hi - k + 1])
        else:
            short = np.full(min(hi - lo, 1), hi - lo, np.uint64)
            for h in words.hash[lo:hi]:
                short = mix64(short * np.uint64(31) + h)
            yield short


def _bands(percent: int) -> tuple[int, int]:
    """Bands and registers of each, so that a pair at ``percent`` is missed at most with MISS."""
    if not 0 < percent <= 100:
        raise ValueError("percent must be from 1 to 100")
    for rows in range(ROWS, 0, -1):
        alike = (percent / 100) ** rows
        bands = max(BANDS, math.ceil(math.log(MISS) / math.log1p(-alike)) if alike < 1 else 1)
        if bands <= MOST_BANDS:
            break
    return bands, rows


def _densify(registers: np.ndarray, full: np.ndarray) -> None:
    """Fill empty bins from bins drawn by hash(bin, attempt) until a full one is met."""
    n_bins = registers.shape[1]
    some = full.any(axis=1)
    row, empty = np.nonzero(~full & some[:, None])
    attempt = 0
    while len(row):
        attempt += 1
        drawn = (mix64(np.arange(n_bins, dtype=np.uint64) + np.uint64(attempt * n_bins)) % np.uint64(n_bins)).astype(int)
        donor = drawn[empty]
        ok = full[row, donor]
        registers[row[ok], empty[ok]] = registers[row[ok], donor[ok]]
        row, empty = row[~ok], empty[~ok]


def _check_bits(s: np.ndarray) -> np.ndarray:
    """The low CHECK_BITS bits of the smallest hash of each bin, 64 bins to a word, by bit."""
    bins = (s >> np.uint64(32)) * np.uint64(CHECK_BINS) >> np.uint64(32)
    least = np.flatnonzero(np.diff(bins.astype(np.int64), prepend=-1))
    planes = np.zeros((CHECK_BITS, CHECK_BINS), np.uint8)
    for plane in range(CHECK_BITS):
        planes[plane, bins[least].astype(int)] = (s[least] >> np.uint64(plane)) & np.uint64(1)
    return np.packbits(planes).view(np.int64)


def _could_link(percent: int, a: str, b: str) -> Column:
    """Whether the sets of the columns prefixed ``a`` and ``b`` may reach the similarity.  A bin
    whose smallest hashes differ holds a shingle that only one set has; if d shingles are not
    shared, both sets together share at most (na + nb - d) / 2."""
    words = CHECK_BINS // 64
    na, nb = F.col(f"{a}_n"), F.col(f"{b}_n")

    def word(i: int) -> Column:
        planes = [F.col(f"{a}_{i + words * p}").bitwiseXOR(F.col(f"{b}_{i + words * p}")) for p in range(CHECK_BITS)]
        return F.bit_count(reduce(lambda x, y: x.bitwiseOR(y), planes))

    differ = sum((word(i) for i in range(1, words)), word(0))
    return (100 * F.least(na, nb) >= percent * F.greatest(na, nb)) & (
        (100 - percent) * (na + nb) >= (100 + percent) * differ)


def _sketch_batches(batches, k: int, n_bands: int, n_rows: int):
    n_bins = n_bands * n_rows
    for whole in batches:
        for batch in slices(whole, "text"):
            n = batch.num_rows
            registers, full = np.zeros((n, n_bins), np.uint64), np.zeros((n, n_bins), bool)
            sizes, keys, checks = np.zeros(n, np.int64), [], []
            for i, s in enumerate(_sets(batch.column("text"), k)):
                sizes[i] = len(s)
                keys.append(hashlib.blake2b(s.tobytes(), digest_size=16).digest() if len(s) else None)
                bins = ((s >> np.uint64(32)) * np.uint64(n_bins) >> np.uint64(32)).astype(int)
                least = np.flatnonzero(np.diff(bins, prepend=-1))
                registers[i, bins[least]] = s[least]
                full[i, bins[least]] = True
                checks.append(_check_bits(s) if len(s) else None)
            _densify(registers, full)
            bands = np.zeros((n, n_bands), np.uint64)
            for j in range(n_rows):
                bands = bands * np.uint64(0xD6E8FEB86659FD93) + registers[:, j::n_rows]
            bands = mix64(bands * np.uint64(n_bands) + np.arange(n_bands, dtype=np.uint64)).view(np.int64)
            yield pa.RecordBatch.from_arrays([
                batch.column("id"), batch.column("hash"), pa.array(sizes), pa.array(keys, pa.binary()), pa.array(checks, pa.list_(pa.int64())),
                pa.array([list(b) if size else None for b, size in zip(bands, sizes)], pa.list_(pa.int64()))],
                ["id", "hash", "n", "key", "checks", "bands"])


def _set_batches(batches, text_col: str, k: int):
    for whole in batches:
        for batch in slices(whole, text_col):
            sets = [s for s in _sets(batch.column(text_col), k)]
            yield pa.RecordBatch.from_arrays([
                pa.array([hashlib.blake2b(s.tobytes(), digest_size=16).digest() for s in sets], pa.binary()),
                pa.array([s.view(np.int64) for s in sets], pa.list_(pa.int64()))], ["key", "shingles"])


class _Graph:
    """The nodes, their buckets, sets and components, kept as written tables."""

    def __init__(self, docs: DataFrame, id_col: str, text_col: str, k: int, percent: int):
        self.percent, narrow = percent, docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
        id_type = narrow.schema["id"].dataType.simpleString()
        bands = _bands(percent)
        self.rows = written(narrow.withColumn("hash", F.xxhash64("text")).mapInArrow(
            lambda it: _sketch_batches(it, k, *bands),
            f"id {id_type}, hash bigint, n bigint, key binary, checks array<bigint>, bands array<bigint>"), "sketches")
        # a class is fetched by one of its rows: the smallest id, a null one only if there is no other
        classes = self.rows.filter("n > 0").groupBy("key").agg(
            F.min("id").alias("low"), F.min(F.struct(F.col("id").isNull().alias("no_id"), "id", "hash")).alias("one"),
            F.first("n").alias("n"), F.first("checks").alias("checks"),
            F.first("bands").alias("bands"))
        # written once, so the generated numbers stay
        self.nodes = written(classes.withColumn("node", F.monotonically_increasing_id()), "classes")
        spread = self.nodes.select(F.explode("bands").alias("bucket"), "node")
        shared = spread.groupBy("bucket").agg(F.min("node").alias("lo"), F.max("node").alias("hi")).filter("lo < hi")
        self.members = written(spread.join(shared.select("bucket"), "bucket", "left_semi"), "members")
        wanted = self.nodes.join(self.members.select("node").distinct(), "node", "left_semi")
        self.checks = written(wanted.select("node", "n", "checks"), "checks")
        ones = wanted.select(F.col("one.id").alias("one_id"), F.col("one.hash").alias("one_hash")).distinct()
        texts_of = narrow.join(ones, F.col("id").eqNullSafe(F.col("one_id")) & (
            F.xxhash64("text") == F.col("one_hash")), "left_semi").select("text")
        sets = texts_of.mapInArrow(lambda it: _set_batches(it, "text", k), "key binary, shingles array<bigint>")
        self.sets = written(wanted.select("key", "node").join(sets, "key").groupBy("node").agg(
            F.first("shingles").alias("shingles")), "sets")
        self.comp = wanted.select("node", F.col("node").alias("comp"))
        self.tested = None

    def open_members(self) -> DataFrame:
        """Members, with component, of the buckets that hold more than one."""
        m = self.members.select("bucket", "node").join(self.comp, "node")
        several = m.groupBy("bucket").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi")).filter("lo < hi")
        return written(m.join(several.select("bucket"), "bucket", "left_semi"), "open")

    def could_link(self) -> Column:
        return _could_link(self.percent, "a", "b")

    def checks_of(self, side: str) -> DataFrame:
        """Set size and check words by node, as plain columns: cheap in a join condition."""
        words = [F.coalesce(F.get("checks", i), F.lit(0).cast("long")).alias(f"{side}_{i}")
                 for i in range(CHECK_BINS // 64 * CHECK_BITS)]
        return self.checks.select(F.col("node").alias(side), F.coalesce("n", F.lit(0).cast("long")).alias(f"{side}_n"), *words)

    def link(self, pairs: DataFrame) -> None:
        """Confirm pairs ``(a, b, a_n, b_n)`` on the full sets; merge the components they join."""
        pairs = pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"),
                             (F.col("a_n") + F.col("b_n")).alias("n")).distinct()
        if self.tested is not None:
            pairs = pairs.join(self.tested, ["a", "b"], "left_anti")
        pairs = written(pairs, "pairs")
        self.tested = pairs if self.tested is None else self.tested.unionByName(pairs)
        of = lambda side: self.sets.select(F.col("node").alias(side), F.col("shingles").alias(f"{side}_set"))
        both = F.size(F.array_intersect("a_set", "b_set")).cast("long")
        edges = written(pairs.join(of("a"), "a").join(of("b"), "b").withColumn("both", both).filter(
            100 * F.col("both") >= self.percent * (F.col("n") - F.col("both"))).select("a", "b"), "links")
        of_a, of_b = (self.comp.select(F.col("node").alias(s), F.col("comp").alias(f"{s}_comp")) for s in "ab")
        joined = components(edges.join(of_a, "a").join(of_b, "b"), "a_comp", "b_comp")
        self.comp = written(self.comp.join(joined.withColumnRenamed("node", "comp"), "comp", "left").select(
            "node", F.coalesce("component", "comp").alias("comp")), "comp")

    def star_round(self, number: int) -> bool:
        """Compare the members of each open bucket with one centre; False if none is open."""
        m = self.open_members()
        if m.isEmpty():
            return False
        centre = m.groupBy("bucket").agg(F.min(F.struct(
            F.xxhash64("node", F.lit(number)).alias("order"), "node", "comp")).alias("c"))
        star = (m.join(centre, "bucket").filter(F.col("comp") != F.col("c.comp"))
                .select(F.col("node").alias("a"), F.col("c.node").alias("b")).distinct())
        self.link(star.join(self.checks_of("a"), "a").join(self.checks_of("b"), "b").filter(self.could_link()))
        return True

    def settle(self) -> None:
        """Compare each member outside its bucket's largest component with the other components."""
        m = self.open_members()
        if m.isEmpty():
            return
        main = m.groupBy("bucket", "comp").count().groupBy("bucket").agg(
            F.max_by("comp", F.struct("count", "comp")).alias("main"))
        a = m.select("bucket", F.col("node").alias("a"), F.col("comp").alias("a_comp"), F.pmod(
            F.xxhash64("node"), F.lit(SALTS)).alias("salt")).join(self.checks_of("a"), "a")
        # a bucket's members are dealt out, and the few outside its main component meet each part
        b = (m.join(main, "bucket").filter("comp != main").select(
            "bucket", F.col("node").alias("b"), F.col("comp").alias("b_comp")).join(self.checks_of("b"), "b")
            .withColumn("salt", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(SALTS - 1).cast("long")))))
        keep = [F.col(c) for c in ("a", "b", "a_n", "b_n")]
        here = (a["bucket"] == b["bucket"]) & (a["salt"] == b["salt"]) & (
            F.col("a_comp") != F.col("b_comp")) & self.could_link()
        self.link(a.join(b, here).select(*keep))


def _components(docs: DataFrame, id_col: str, text_col: str, words: int, percent: int) -> DataFrame:
    """``(id, hash, n, comp, component_id)`` of every row: hash is that of its text, comp a number of its
    component (null without shingles)."""
    g = _Graph(docs, id_col, text_col, words, percent)
    for number in range(STAR_ROUNDS):
        if not g.star_round(number):
            break
    else:
        g.settle()
    # smallest document id of each component of classes, then back to the rows by set key
    node_comp = g.nodes.select("node", "key", "low").join(g.comp, "node", "left").withColumn(
        "comp", F.coalesce("comp", "node"))
    lowest = node_comp.groupBy("comp").agg(F.min("low").alias("component_id"))
    of_key = node_comp.join(lowest, "comp").select("key", "comp", "component_id")
    return g.rows.select("id", "hash", "n", "key").join(of_key, "key", "left").select(
        "id", "hash", "n", "comp", F.when(F.col("n") == 0, F.col("id")).otherwise(F.col("component_id")).alias("component_id"))


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    words: int = 5, percent: int = 80) -> DataFrame:
    """One row per document: ``id_col``, ``n_shingles``, ``component_id``, ``kept``.

    Documents whose sets of distinct ``words``-word shingles have Jaccard similarity of at least
    ``percent`` / 100 are linked; a component's id is the smallest document id reachable, and the
    document that carries it is kept.  Words are runs of anything but ASCII white space with A-Z
    folded; a text of fewer words is one shingle.

    Defined results: null, empty or blank text has no shingle, links with nothing and is kept.
    Rows that repeat a document id with the same text are one node; each row comes back.  Rows
    of one id with different texts are nodes of their own.  A null id sorts after all others and links
    like any other; a component of null ids only has a null component id, and its rows are marked as
    kept.  Other columns are ignored.
    """
    found = _components(docs, id_col, text_col, words, percent)
    return found.select(F.col("id").alias(id_col), F.col("n").alias("n_shingles"), "component_id",
                        F.col("id").eqNullSafe(F.col("component_id")).alias("kept"))


def drop_near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                         words: int = 5, percent: int = 80) -> DataFrame:
    """``docs`` with exactly one row of each component: that of its smallest id (of one id, of the text
    with the smallest hash; a null id only if there is no other).

    Rows that repeat id and text are one document, whatever their other columns, and one of them
    stays.  Rows without shingles are components of their own and all stay.  Columns of any name
    stay as they are.
    """
    found = written(_components(docs, id_col, text_col, words, percent).filter("n > 0"), "components")
    place = F.struct(F.col("id").isNull().alias("no_id"), "id", "hash")
    first = found.groupBy("comp").agg(F.min(place).alias("first"))
    ranked = found.join(first, "comp").select("id", "hash", (place == F.col("first")).alias("kept"))
    gone_id, gone_hash = (free_name(docs.columns, c) for c in ("gone_id", "gone_hash"))
    own_hash = F.xxhash64(F.col(f"`{text_col}`"))

    def keys(rows: DataFrame) -> DataFrame:
        return rows.select(F.col("id").alias(gone_id), F.col("hash").alias(gone_hash))

    here = F.col(f"`{id_col}`").eqNullSafe(F.col(gone_id)) & (own_hash == F.col(gone_hash))
    left = docs.join(keys(ranked.filter("not kept")).distinct(), here, "left_anti")
    # rows that repeat a kept document: one of each goes on
    repeated = written(keys(ranked.filter("kept").groupBy("id", "hash").count().filter("count > 1")), "repeated")
    if repeated.isEmpty():
        return left
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    one = left.join(repeated, here).groupBy(gone_id, gone_hash).agg(
        F.min_by(row, F.xxhash64(*[F.col(f"`{c}`") for c in docs.columns if c != text_col])).alias("row")).select("row.*")
    return left.join(repeated, here, "left_anti").unionByName(one)
