"""Counts taken while a frame is written (A15 as an observed metric): one pass, not two.

``Observation`` counts the rows that pass a point of the plan, so "write it only if it has rows" needs no
run of its own to look: the frame is written, and an empty output is withdrawn.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F


def counted(df: DataFrame) -> tuple[DataFrame, Callable[[], int]]:
    """The frame, and how many rows its next action has passed on (0 if Spark left the plan out, as it
    does for a relation that it knows to be empty)."""
    seen = Observation()
    out = df.observe(seen, F.count(F.lit(1)).alias("n"))
    return out, lambda: int(seen.get.get("n") or 0)


def withdraw(spark, path: str) -> None:
    """Remove a written output."""
    jvm = spark.sparkContext._jvm
    at = jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(at, True)


def write_if_any(df: DataFrame, path: str, write: Callable[[DataFrame, str], None]) -> int:
    """Run ``write(frame, path)`` and withdraw its output if no row came; returns the rows written."""
    rows, count = counted(df)
    write(rows, path)
    n = count()
    if not n:
        withdraw(df.sparkSession, path)
    return n
