"""Run one user SQL text (Spark SQL, or an external database through JDBC)."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession

from ..operators.clean import decimal_to_double


def sql_query(spark: SparkSession, text: str, params: Mapping[str, object] | None = None,
              decimals_as_double: bool = True) -> DataFrame:
    """One statement (a trailing ``;`` is dropped) with named parameters bound safely."""
    stmt = text.strip()
    while stmt.endswith(";"):
        stmt = stmt[:-1].rstrip()
    df = spark.sql(stmt, args=dict(params)) if params else spark.sql(stmt)
    return decimal_to_double(df) if decimals_as_double else df


def jdbc_query(spark: SparkSession, url: str, text: str, properties: Mapping[str, str] | None = None,
               decimals_as_double: bool = True, **partitioning) -> DataFrame:
    """Push a whole statement to an external database; optional ``partitionColumn``,
    ``lowerBound``, ``upperBound``, ``numPartitions`` read it in parallel."""
    rd = spark.read.format("jdbc").option("url", url).option("query", text.strip().rstrip(";"))
    for k, v in dict(properties or {}).items():
        rd = rd.option(k, v)
    for k, v in partitioning.items():
        rd = rd.option(k, v)
    df = rd.load()
    return decimal_to_double(df) if decimals_as_double else df
