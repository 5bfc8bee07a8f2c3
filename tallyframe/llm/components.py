"""Connected components by alternating large-star and small-star steps over edge tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .tables import written


def _mark(edges: DataFrame):
    return edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()


def components(edges: DataFrame, a: str, b: str) -> DataFrame:
    """``(node, component)`` for every node on an edge; component = smallest node reachable.

    Each step aggregates a minimum per node (combined before the shuffle) and joins it back to
    the node's edges; hub nodes are split by the adaptive skew join.  Steps are written tables,
    about log(n) of them.  Self edges and repeated edges are allowed.
    """
    now = written(edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v"))
                  .filter("u > v").distinct(), "edges")
    mark = _mark(now)
    while mark[0]:
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = (both.join(low, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .filter("u > v").distinct())
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").select(F.explode(F.array(
            F.struct("v", "m"), F.struct(F.col("u").alias("v"), "m"))).alias("e")).select("e.*")
        now = written(small.select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u > v").distinct(), "stars")
        before, mark = mark, _mark(now)
        if mark == before:
            break
    tops = now.select(F.col("v").alias("node")).distinct()
    return now.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(
        tops.select("node", F.col("node").alias("component")))
