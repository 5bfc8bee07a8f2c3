"""Box statistics from stored quantile sketches (A9 in its approximate form).

A KLL sketch of each (day, group) is stored once.  Sketches are mergeable, so the quantiles of any
range of days come from the range's sketches: no base row is read again.  The rank of a quantile is off by
at most ``rank_error(k)`` of the rows, merged or not; the smallest and largest value are exact.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Size parameter of a sketch: about 2k values are kept, whatever the number of rows.
K = 400


def rank_error(k: int = K) -> float:
    """Error of a rank, as a share of the rows, that a sketch exceeds in fewer than one of 100 queries
    (the fitted bound of the sketch's authors)."""
    return 2.296 / k ** 0.9723


def sketch_days(df: DataFrame, day: str, group: str, value: str, k: int = K) -> DataFrame:
    """``(day, group, sketch, n)``: one mergeable sketch per day and group, from one aggregation that
    is combined before the shuffle.  Null keys, null and NaN values are left out."""
    v = F.nanvl(F.col(value).cast("double"), F.lit(None).cast("double"))
    rows = df.select(F.col(day).alias("day"), F.col(group).alias("group"), v.alias("value")).na.drop()
    return rows.groupBy("day", "group").agg(F.kll_sketch_agg_double("value", F.lit(k)).alias("sketch"),
                                            F.count("*").alias("n"))


def store_sketches(sketches: DataFrame, path: str) -> None:
    """Write sketches by day; writing a day again replaces it, and no other."""
    sketches.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("day").parquet(path)


def range_quantiles(stored: DataFrame, first: str, last: str, probabilities: Sequence[float] = (0.25, 0.5, 0.75),
                    ) -> DataFrame:
    """``(group, n, smallest, largest, quantiles)`` of the days from ``first`` to ``last``: only the sketches
    of these days are read and merged.  An empty range gives no row."""
    days = stored.filter(F.col("day").between(first, last))
    merged = days.groupBy("group").agg(F.kll_merge_agg_double("sketch").alias("sketch"), F.sum("n").alias("n"))
    wanted = F.array(*[F.lit(float(p)) for p in (0.0, *probabilities, 1.0)])
    found = merged.select("group", "n", F.kll_sketch_get_quantile_double("sketch", wanted).alias("q"))
    size = len(probabilities)
    return found.select("group", "n", F.get("q", 0).alias("smallest"), F.get("q", size + 1).alias("largest"),
                        F.slice("q", 2, size).alias("quantiles"))


def range_box(stored: DataFrame, first: str, last: str) -> DataFrame:
    """``(group, n, smallest, q1, median, q3, largest)`` of a range of days."""
    q = range_quantiles(stored, first, last)
    return q.select("group", "n", "smallest", *[F.get("quantiles", i).alias(c) for i, c in enumerate(("q1", "median", "q3"))], "largest")
