"""Written intermediate tables: lineage ends in the shared checkpoint folder."""

from __future__ import annotations

from pyspark.sql import DataFrame

from ..session import scratch_dir


def written(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` under the session's checkpoint folder and read it back.

    A lost executor then costs the tasks of the step at hand, and what a step saw (sampled
    bounds, generated ids) stays as it was written.
    """
    path = scratch_dir(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def free_name(columns: list[str], name: str) -> str:
    """``name``, with as many underscores before it as it takes not to be one of ``columns``."""
    taken = {c.lower() for c in columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name
