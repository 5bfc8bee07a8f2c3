"""The registry as bitmaps (J1): which filesets a system has, as sets of bits.

Filesets are numbered, and a system's filesets are bits, one compressed bitmap per bucket of 32,768
numbers: only its words of 64 bits that have a bit set are kept, so a system with few of many
filesets is as small as its pairs.  Counts come from the bitmaps; the pairs that a system lacks are the
clear bits, and they are only spelled out for the systems that are asked for.  The work follows the
pairs that exist.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import materialise
from .ranking import grouped_row_number

#: Bits of one bitmap, and of one of its words.
BUCKET_BITS = 32_768
WORD_BITS = 64


def number_filesets(filesets: DataFrame) -> DataFrame:
    """``(fileset, number)`` of the master list, numbered from 0 by name."""
    names = filesets.select("fileset").na.drop().distinct()
    return grouped_row_number(names, [], ["fileset"], out="number").withColumn("number", F.col("number") - 1)


def _bitmaps(words: DataFrame) -> DataFrame:
    """``(system, word, bits)``, words of the same place united → ``(system, bucket, bits)``."""
    united = words.groupBy("system", "word").agg(F.bit_or("bits").alias("bits"))
    bucket = F.expr(f"word div {BUCKET_BITS // WORD_BITS}")
    return united.groupBy("system", bucket.alias("bucket")).agg(F.collect_list(F.struct("word", "bits")).alias("bits"))


def registry_bitmaps(pairs: DataFrame, numbered: DataFrame) -> DataFrame:
    """``(system, bucket, bits)``: the known filesets of each system, as many bitmaps as it has buckets;
    ``bits`` lists a bitmap's words that are not empty as ``(word, bits)``, numbered over all buckets."""
    have = pairs.select("system", "fileset").join(numbered, "fileset")
    return _bitmaps(have.select("system", F.expr(f"number div {WORD_BITS}").alias("word"),
                                F.expr(f"shiftleft(1L, cast(number % {WORD_BITS} as int))").alias("bits")))


def merge_bitmaps(*registries: DataFrame) -> DataFrame:
    """The union of registries over one numbering: bits set in any of them."""
    rows = registries[0]
    for r in registries[1:]:
        rows = rows.unionByName(r)
    return _bitmaps(rows.select("system", F.inline("bits")))


def _held(bits: str) -> Column:
    """Bits set in a bitmap."""
    return F.aggregate(bits, F.lit(0).cast("long"), lambda n, w: n + F.bit_count(w["bits"]))


def fileset_counts(systems: DataFrame, bitmaps: DataFrame, numbered: DataFrame) -> DataFrame:
    """``(system, n_known, n_missing)`` of every system, from the bitmaps alone."""
    total = numbered.select(F.count("*")).scalar()
    have = bitmaps.groupBy("system").agg(F.sum(_held("bits")).alias("n_known"))
    known = F.coalesce("n_known", F.lit(0).cast("long"))
    return systems.select("system").distinct().join(have, "system", "left").select(
        "system", known.alias("n_known"), (total - known).alias("n_missing"))


def missing_pairs(systems: DataFrame, bitmaps: DataFrame, numbered: DataFrame) -> DataFrame:
    """``(system, fileset)``: what each of ``systems`` lacks of the master list.

    Each system's clear bits are spelled out word by word, so the work of a system with a long
    list is cut into pieces and every system is its own; names are joined by number at the end.
    """
    numbered = materialise(numbered, "numbered")
    last = numbered.agg(F.max("number")).first()[0]
    if last is None:
        return systems.select("system", F.lit("").alias("fileset")).limit(0)
    every = systems.select("system").distinct().select("system", F.explode(F.sequence(
        F.lit(0).cast("long"), F.lit(last // WORD_BITS).cast("long"))).alias("word"))
    have = bitmaps.select(F.col("system").alias("__s"), F.inline("bits").alias("__w", "bits"))
    rows = every.join(have, F.col("system").eqNullSafe(F.col("__s")) & (F.col("word") == F.col("__w")), "left")
    upto = F.least(F.lit(WORD_BITS - 1).cast("long"), F.lit(last) - F.col("word") * WORD_BITS)
    bits = rows.select("system", "word", F.coalesce("bits", F.lit(0).cast("long")).alias("bits"),
                       F.explode(F.sequence(F.lit(0).cast("long"), upto)).alias("place"))
    absent = bits.filter(F.getbit("bits", F.col("place").cast("int")) == 0).select(
        "system", (F.col("word") * WORD_BITS + F.col("place")).alias("number"))
    return absent.join(numbered, "number").select("system", "fileset")
