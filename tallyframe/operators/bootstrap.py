"""Bootstrap intervals of group means (A2-A5) by a Poisson bootstrap.

A bootstrap replica draws rows with replacement; over many rows, each row's count in a replica is
an independent Poisson(1) number.  Here that number comes from the md5 of the row's key and the
replica, so a replica is a property of the data: every scan, retry and partitioning, and any other
engine, draws the same rows.  A replica's sums are mergeable, so they are summed before the shuffle
and a hot group costs no more than others; no row is moved, repeated or collected.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Replicas and level of an interval.
REPLICAS, LEVEL = 200, 0.95
#: Replicas that one md5 gives (four hexadecimal digits each); their sums are one generated aggregate.
PER_DIGEST = 8
DIGITS = 4


def poisson_thresholds(digits: int = DIGITS) -> list[str]:
    """Hexadecimal numbers that a draw of ``digits`` digits reaches with the probabilities that a
    Poisson(1) number is at least 1, 2, ..., as far as the digits can tell."""
    size, below, term, out = 16 ** digits, 0.0, math.exp(-1), []
    for k in range(1, 20):
        below += term
        term /= k
        at = round(size * below)
        if at >= size:
            break
        out.append(f"{at:0{digits}x}")
    return out


def _weight(digest: Column, place: int) -> Column:
    """Times that a row is in a replica: fixed-width hexadecimal text compares as its number."""
    draw = F.substring(digest, place * DIGITS + 1, DIGITS)
    return sum((F.when(draw >= t, 1).otherwise(0) for t in poisson_thresholds()[1:]),
               F.when(draw >= poisson_thresholds()[0], 1).otherwise(0))


def replica_sums(df: DataFrame, keys: Sequence[str], value: str, row_key: Sequence[str],
                 replicas: int = REPLICAS) -> DataFrame:
    """``(keys, replica, total, rows)``: each group's weighted sum and count in every replica.

    ``row_key`` are the columns that tell rows apart; rows with equal keys are drawn together.
    Null values are left out.  The rows pass one aggregation, and what it shuffles are sums.
    """
    keys, blocks = list(keys), -(-replicas // PER_DIGEST)
    name = F.concat_ws("|", *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in row_key])
    rows = df.filter(F.col(value).isNotNull()).select(
        *keys, F.col(value).cast("double").alias("__v"), name.alias("__row"),
        F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("__block"))
    rows = rows.select(*keys, "__v", "__block", F.md5(F.concat_ws("#", "__row", F.col("__block").cast("string"))).alias("__d"))
    rows = rows.select(*keys, "__v", "__block", *[_weight(F.col("__d"), i).alias(f"__w{i}") for i in range(PER_DIGEST)])
    sums = [f(i) for i in range(PER_DIGEST) for f in (
        lambda i: F.sum(F.col("__v") * F.col(f"__w{i}")).alias(f"__t{i}"), lambda i: F.sum(f"__w{i}").alias(f"__n{i}"))]
    blocks_ = rows.groupBy(*keys, "__block").agg(*sums)
    each = F.array(*[F.struct((F.col("__block") * PER_DIGEST + i).alias("replica"), F.col(f"__t{i}").alias("total"),
                              F.col(f"__n{i}").alias("rows")) for i in range(PER_DIGEST)])
    return blocks_.select(*keys, F.inline(each)).filter(F.col("replica") < replicas)


def bootstrap_mean(df: DataFrame, keys: Sequence[str], value: str, row_key: Sequence[str],
                   replicas: int = REPLICAS, level: float = LEVEL) -> DataFrame:
    """``(keys, mean, n, ci_lo, ci_hi)``: the mean of each group and the percentile interval of its
    means over the replicas.

    Defined results: groups with a null key are left out, as by the other chart operators; NaN and
    null values count as missing, and a group of nothing else has null results and n 0; replicas
    without a row of the group are left out; a single row's interval is its value; an empty table
    gives no row.  ``n`` and ``mean`` are exact: replica -1 stands for the rows themselves.
    """
    keys = list(keys)
    base = df.select(*keys, F.nanvl(F.col(value).cast("double"), F.lit(None).cast("double")).alias("__value"),
                     *[F.col(c).alias(f"__k{i}") for i, c in enumerate(row_key)])
    for k in keys:
        base = base.filter(F.col(k).isNotNull())
    sums = replica_sums(base, keys, "__value", [f"__k{i}" for i in range(len(row_key))], replicas)
    own = base.groupBy(*keys).agg(F.sum("__value").alias("total"), F.count("__value").alias("rows")).select(
        *keys, F.lit(-1).alias("replica"), "total", "rows")
    ratio, drawn = F.try_divide("total", "rows"), F.col("replica") >= 0
    tail = (1 - level) / 2
    return own.unionByName(sums).groupBy(*keys).agg(
        F.max(F.when(~drawn, ratio)).alias("mean"), F.max(F.when(~drawn, F.col("rows"))).alias("n"),
        F.percentile(F.when(drawn, ratio), tail).alias("ci_lo"), F.percentile(F.when(drawn, ratio), 1 - tail).alias("ci_hi"))
