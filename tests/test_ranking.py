"""Slice-based numbering against plain windows: payload columns, hot groups, any plan reuse."""
import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from tallyframe.operators.charts import exact_quantiles
from tallyframe.operators.ranking import grouped_cumulative, grouped_row_number

LINEITEM = "/root/testdata/sf0.1/lineitem.parquet"


@pytest.fixture(params=[True, False])
def reuse(spark, request):
    spark.conf.set("spark.sql.exchange.reuse", request.param)
    yield request.param
    spark.conf.unset("spark.sql.exchange.reuse")


def hot(spark):
    return spark.read.parquet(LINEITEM).repartition(16).withColumn(
        "g", F.when(F.col("l_orderkey") % 3 == 0, F.lit("hot")).otherwise(F.col("l_suppkey").cast("string")))


def test_grouped_numbers_all_columns(spark, reuse):
    df = hot(spark)
    got = grouped_row_number(df, ["g"], ["l_shipdate", "l_orderkey", "l_linenumber"], num_partitions=16)
    exp = F.row_number().over(Window.partitionBy("g").orderBy("l_shipdate", "l_orderkey", "l_linenumber"))
    both = got.withColumn("exp", exp)
    assert both.count() == df.count()
    assert both.filter(F.col("rn") != F.col("exp")).count() == 0 or ties_only(both)


def ties_only(both):
    wrong = both.filter(F.col("rn") != F.col("exp"))
    dup = both.groupBy("g", "l_shipdate", "l_orderkey", "l_linenumber").count().filter("count > 1")
    return wrong.join(dup, ["g", "l_shipdate", "l_orderkey", "l_linenumber"], "left_anti").count() == 0


def test_global_numbers_are_dense_with_payload(spark, reuse):
    got = grouped_row_number(spark.read.parquet(LINEITEM).repartition(16), [], ["l_partkey"], num_partitions=16)
    n, d, lo, hi = got.agg(F.count("*"), F.countDistinct("rn"), F.min("rn"), F.max("rn")).first()
    assert n == d == hi and lo == 1


def test_cumulative_matches_window(spark, reuse):
    df = hot(spark).groupBy("g", "l_extendedprice").agg(F.count("*").alias("c"))
    got = grouped_cumulative(df, ["g"], ["l_extendedprice"], "c", before="b", total="n", num_partitions=16)
    w = Window.partitionBy("g").orderBy("l_extendedprice").rowsBetween(Window.unboundedPreceding, -1)
    exp = df.withColumn("eb", F.coalesce(F.sum("c").over(w), F.lit(0))).withColumn(
        "en", F.sum("c").over(Window.partitionBy("g")))
    j = got.join(exp, ["g", "l_extendedprice"])
    assert j.count() == df.count()
    assert j.filter((F.col("b") != F.col("eb")) | (F.col("n") != F.col("en"))).count() == 0


def test_quantiles_do_not_depend_on_reuse(spark, reuse):
    got = {r["l_returnflag"]: (r["q25"], r["q50"], r["q75"]) for r in exact_quantiles(
        spark.read.parquet(LINEITEM), ["l_returnflag"], "l_extendedprice").collect()}
    exp = {r[0]: tuple(r[1]) for r in spark.read.parquet(LINEITEM).groupBy("l_returnflag").agg(
        F.percentile("l_extendedprice", F.array(F.lit(0.25), F.lit(0.5), F.lit(0.75)))).collect()}
    for k in exp:
        assert all(abs(a - b) < 1e-6 for a, b in zip(got[k], exp[k]))


def test_nulls_ties_and_empty(spark):
    df = spark.createDataFrame([(None, 1, "x"), (None, None, "y"), ("a", 2, "z"), ("a", 2, "z"), ("b", None, None)],
                               "g string, o int, p string")
    got = sorted((str(r["g"]), r["rn"]) for r in grouped_row_number(df, ["g"], ["o"], num_partitions=4).collect())
    assert got == [("None", 1), ("None", 2), ("a", 1), ("a", 2), ("b", 1)]
    assert grouped_row_number(df.limit(0), ["g"], ["o"], num_partitions=4).count() == 0


@pytest.mark.parametrize("slices", [3, 300])
def test_many_slices_number_alike(spark, slices):
    """Split points as literals and as a table; groups cut by many of them, nulls, decimals and doubles as weights."""
    df = spark.range(20_000).select(
        F.when(F.col("id") % 3 > 0, "hot").when(F.col("id") % 50 > 0, F.concat(F.lit("g"), F.col("id") % 400)).alias("g"),
        (F.col("id") * 7919 % 10_007).alias("o"), (F.col("id") % 13).cast("decimal(10,2)").alias("d"), (F.col("id") % 7 / 4).alias("x"), "id")
    got = grouped_row_number(df, ["g"], ["o", "id"], num_partitions=slices)
    w = Window.partitionBy("g").orderBy("o", "id")
    assert got.withColumn("e", F.row_number().over(w)).filter("rn <> e").count() == 0
    upto = w.rowsBetween(Window.unboundedPreceding, -1)
    for weight in ("d", "x", "id"):
        got = grouped_cumulative(df, ["g"], ["o", "id"], weight, before="b", total="n", num_partitions=slices)
        both = got.withColumns({"eb": F.coalesce(F.sum(weight).over(upto), F.lit(0)), "en": F.sum(weight).over(Window.partitionBy("g"))})
        assert both.count() == 20_000
        assert both.filter("abs(b - eb) > 1e-6 or abs(n - en) > 1e-6").count() == 0
    got = grouped_row_number(df, [], ["o", "id"], num_partitions=slices)
    assert got.withColumn("e", F.row_number().over(Window.orderBy("o", "id"))).filter("rn <> e").count() == 0


def test_sampling_gathers_in_no_single_task_and_plans_stay_small(spark):
    df = spark.range(200_000).withColumn("g", F.col("id") % 5)
    sizes = {}
    for n in (100, 3000):
        plan = grouped_row_number(df, ["g"], ["id"], num_partitions=n)._jdf.queryExecution().analyzed().toString()
        assert "GlobalLimit" not in plan
        sizes[n] = len(plan)
    assert sizes[3000] < 1.6 * sizes[100]
