"""Plan-shape checks: no cartesian products, pruned scans, skew-safe numbering."""
import pytest
from pyspark.sql import functions as F

from tallyframe.operators.ranking import grouped_row_number
from tallyframe.workload import catalogue

from .conftest import SF_SMALL

PURE = ["q_charts", "q_text", "q_frames", "q_registry", "q_template", "q_report"]


def plan_of(df):
    return df.sparkSession._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted")


def pure_queries():
    import importlib
    out = {}
    for m in PURE:
        out.update(importlib.import_module(f"tallyframe.workload.{m}").Q)
    return out


@pytest.mark.parametrize("key", sorted(pure_queries()))
def test_no_cartesian_products(spark, key):
    plan = plan_of(pure_queries()[key](spark, SF_SMALL))
    assert "CartesianProduct" not in plan
    assert "BroadcastNestedLoopJoin" not in plan


def test_heatmap_scan_is_pruned(spark):
    q, _ = catalogue()
    plan = plan_of(q["hour_heatmap"](spark, SF_SMALL))
    assert "ReadSchema: struct<ts:timestamp_ntz,user_id:bigint>" in plan


def test_numbering_shuffles_once(spark):
    df = spark.range(1000).select((F.col("id") % 3).alias("g"), F.lit(1).alias("o"), "id")
    plan = plan_of(grouped_row_number(df, ["g"], ["o"]))
    assert "Join" not in plan and plan.count("+- Exchange") == 1
    # all rows of a group tie on the order key; the row hash still spreads them and the
    # numbering stays dense
    got = sorted(r["rn"] for r in grouped_row_number(df, ["g"], ["o"], num_partitions=8).filter("g = 0").collect())
    assert got == list(range(1, 335))


@pytest.mark.parametrize("key", ["stacked_histogram", "heat_contrast", "vs_overall_mean"])
def test_global_statistics_run_once(spark, key):
    # min/max/mean of the whole input form one bound scalar subquery, not one per reference
    import re
    q, _ = catalogue()
    df = q[key](spark, SF_SMALL)
    df.write.format("noop").mode("overwrite").save()
    plan = plan_of(df)
    assert plan.count("Subquery:") == 1
    assert len(re.findall(r"^\(\d+\) Scan parquet", plan, re.M)) <= 2
