"""Chart aggregations (A*, W1, W2, U2, P6-P8, P12, O1) on the driver tables, with oracles."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import charts as C
from ..operators import clean as P
from ..operators import sketches as SK
from ..operators.bootstrap import poisson_thresholds
from ..session import materialise, scratch_dir
from .tables import r6, table

Q: dict = {}
SQL: dict = {}


def reg(name, sql=None):
    def deco(fn):
        Q[name] = fn
        if sql is not None:
            SQL[name] = sql
        return fn
    return deco


def _cells(spark, sf):
    return C.concurrency_cells(table(spark, sf, "events"))


_CELLS_SQL = """
WITH cells AS (
  SELECT strftime(ts, '%Y-%m-%d') AS LogDate, hour(ts) AS LogHour,
         count(DISTINCT user_id) AS Concurrency_Peak
  FROM events GROUP BY 1, 2)
"""

_HOUR_COLS = ",\n  ".join(
    f"max(Concurrency_Peak) FILTER (WHERE lpad(CAST(LogHour AS VARCHAR), 2, '0') = '{h}') AS \"{h}\""
    for h in C.HOURS)


@reg("hour_heatmap", _CELLS_SQL + f"SELECT LogDate,\n  {_HOUR_COLS}\nFROM cells GROUP BY LogDate")
def q_hour_heatmap(spark, sf):
    return C.hour_heatmap(P.pad_hour(_cells(spark, sf)), "Concurrency_Peak")


@reg("heat_contrast", _CELLS_SQL + """
, b AS (SELECT min(Concurrency_Peak)::DOUBLE AS lo, max(Concurrency_Peak)::DOUBLE AS hi FROM cells)
SELECT LogDate, LogHour, Concurrency_Peak,
       round((Concurrency_Peak - lo) / (hi - lo), 6) AS norm,
       (Concurrency_Peak - lo) / (hi - lo) > 0.5 AS dark
FROM cells, b""")
def q_heat_contrast(spark, sf):
    return r6(C.heat_contrast(_cells(spark, sf), "Concurrency_Peak"))


@reg("pad_hour", _CELLS_SQL + """
SELECT LogDate, lpad(CAST(LogHour AS VARCHAR), 2, '0') AS LogHour, Concurrency_Peak FROM cells""")
def q_pad_hour(spark, sf):
    return P.pad_hour(_cells(spark, sf))


@reg("log_time", _CELLS_SQL + """
SELECT LogDate || ' h' || lpad(CAST(LogHour AS VARCHAR), 2, '0') AS LogTime, LogDate,
       lpad(CAST(LogHour AS VARCHAR), 2, '0') AS LogHour, Concurrency_Peak FROM cells""")
def q_log_time(spark, sf):
    return P.log_time(P.pad_hour(_cells(spark, sf)))


@reg("clean_log_frame", _CELLS_SQL + """
SELECT LogDate || ' h' || lpad(CAST(LogHour AS VARCHAR), 2, '0') AS LogTime, LogDate,
       lpad(CAST(LogHour AS VARCHAR), 2, '0') AS LogHour, Concurrency_Peak FROM cells""")
def q_clean_log_frame(spark, sf):
    raw = _cells(spark, sf).select(
        F.lit(0).alias("Unnamed: 0"), "LogDate", "LogHour", "Concurrency_Peak",
        F.lit("x").alias("SiteID"))
    return P.clean_log_frame(raw, index=["logdate", "LOGHOUR"], data=["concurrency_peak"])


@reg("sort_by_index", _CELLS_SQL + """
SELECT LogDate, lpad(CAST(LogHour AS VARCHAR), 2, '0') AS LogHour, Concurrency_Peak
FROM cells ORDER BY 1, 2""")
def q_sort_by_index(spark, sf):
    raw = P.pad_hour(_cells(spark, sf))
    return P.clean_log_frame(raw, index=["LogDate", "LogHour"], data=[], sort=True).drop("LogTime")


@reg("group_mean_rounded", """
WITH g AS (SELECT event_type, CAST(round_even(avg(value), 0) AS BIGINT) AS mean_value
           FROM events WHERE event_type IS NOT NULL GROUP BY event_type)
SELECT event_type, mean_value,
       CASE WHEN mean_value < avg(mean_value) OVER () THEN 'red' ELSE 'green' END AS flag
FROM g""")
def q_group_mean_rounded(spark, sf):
    return C.group_mean_rounded(table(spark, sf, "events"), "event_type", "value")


@reg("sort_by_value", """
WITH g AS (SELECT l_linestatus, CAST(round_even(avg(l_quantity), 0) AS BIGINT) AS mean_qty
           FROM lineitem WHERE l_linestatus IS NOT NULL GROUP BY l_linestatus)
SELECT l_linestatus, mean_qty,
       CASE WHEN mean_qty < avg(mean_qty) OVER () THEN 'red' ELSE 'green' END AS flag
FROM g ORDER BY mean_qty""")
def q_sort_by_value(spark, sf):
    return C.group_mean_rounded(table(spark, sf, "lineitem"), "l_linestatus", "l_quantity",
                                out="mean_qty")


@reg("vs_overall_mean", """
WITH g AS (SELECT o_orderpriority, avg(o_totalprice) AS mean_price FROM orders
           WHERE o_orderpriority IS NOT NULL GROUP BY o_orderpriority)
SELECT o_orderpriority, round(mean_price, 6) AS mean_price,
       CASE WHEN mean_price < avg(mean_price) OVER () THEN 'red' ELSE 'green' END AS flag,
       round(mean_price - avg(mean_price) OVER (), 6) AS diff
FROM g""")
def q_vs_overall_mean(spark, sf):
    agg = table(spark, sf, "orders").groupBy("o_orderpriority").agg(
        F.avg("o_totalprice").alias("mean_price"))
    return r6(C.vs_overall_mean(agg, "mean_price", flag="flag", diff="diff"))


_CI = "1.959963984540054"


@reg("group_mean_ci", f"""
SELECT o_orderstatus, o_orderpriority, round(avg(o_totalprice), 6) AS mean,
       round(stddev_samp(o_totalprice), 6) AS sd, count(o_totalprice) AS n,
       round(avg(o_totalprice) - {_CI} * stddev_samp(o_totalprice) / sqrt(count(o_totalprice)), 6) AS ci_lo,
       round(avg(o_totalprice) + {_CI} * stddev_samp(o_totalprice) / sqrt(count(o_totalprice)), 6) AS ci_hi
FROM orders WHERE o_orderstatus IS NOT NULL AND o_orderpriority IS NOT NULL
GROUP BY 1, 2""")
def q_group_mean_ci(spark, sf):
    return r6(C.group_mean_ci(table(spark, sf, "orders"), "o_orderstatus", "o_totalprice",
                              hue="o_orderpriority"))


_HOURLY = """
WITH hm AS (SELECT date_trunc('hour', ts) AS bucket, event_type, max(value) AS value
            FROM events GROUP BY 1, 2)
"""


def _trend_sql(key_expr, key_name, extra=""):
    return _HOURLY + f"""
SELECT {key_expr} AS {key_name}, event_type{extra}, round(avg(value), 6) AS mean,
       round(stddev_samp(value), 6) AS sd, count(value) AS n,
       round(avg(value) - {_CI} * stddev_samp(value) / sqrt(count(value)), 6) AS ci_lo,
       round(avg(value) + {_CI} * stddev_samp(value) / sqrt(count(value)), 6) AS ci_hi
FROM hm WHERE event_type IS NOT NULL GROUP BY ALL"""


def _hourly(spark, sf):
    return C.daily_max(table(spark, sf, "events"), "ts", "event_type", "value", grain="hour")


@reg("trend_daily", _trend_sql("strftime(bucket, '%Y-%m-%d')", "day"))
def q_trend_daily(spark, sf):
    return r6(C.trend_daily(_hourly(spark, sf), "bucket", "event_type", "value"))


@reg("trend_weekly", _trend_sql("strftime(date_trunc('week', bucket), '%Y-%m-%d')", "week_start"))
def q_trend_weekly(spark, sf):
    return r6(C.trend_weekly(_hourly(spark, sf), "bucket", "event_type", "value"))


@reg("trend_weekday", _trend_sql("CAST(isodow(bucket) - 1 AS INTEGER)", "weekday",
                                 ", dayname(bucket) AS weekday_name"))
def q_trend_weekday(spark, sf):
    return r6(C.trend_weekday(_hourly(spark, sf), "bucket", "event_type", "value"))


def _bootstrap_sql(source, keys, value, row_key, out, replicas=200):
    """Poisson counts from the same md5 as the Spark side; ``out`` selects from the groups g."""
    steps = " + ".join(f"CAST(draw >= '{t}' AS INTEGER)" for t in poisson_thresholds())
    names = ", ".join(keys)
    name = " || '|' || ".join(f"coalesce(CAST({c} AS VARCHAR), '')" for c in row_key)
    null = " AND ".join(f"{k} IS NOT NULL" for k in keys)
    return f"""
WITH src AS ({source}),
src_rows AS (SELECT {names}, {value} AS v, {name} AS row_name FROM src WHERE {null}),
drawn AS (SELECT {names}, v, replica, substr(md5(row_name || '#' || CAST(replica // 8 AS VARCHAR)), CAST(replica % 8 * 4 + 1 AS INT), 4) AS draw
  FROM src_rows, unnest(range({replicas})) AS u(replica)),
r AS (SELECT {names}, replica, sum(v * ({steps})) / sum({steps}) AS m FROM drawn WHERE v IS NOT NULL
  GROUP BY {names}, replica HAVING sum({steps}) > 0),
b AS (SELECT {names}, quantile_cont(m, 0.025) AS ci_lo, quantile_cont(m, 0.975) AS ci_hi FROM r GROUP BY {names}),
g AS (SELECT {names}, avg(v) AS mean, count(v) AS n FROM src_rows GROUP BY {names})
SELECT {out}, round(mean, 6) AS mean, n, round(ci_lo, 6) AS ci_lo, round(ci_hi, 6) AS ci_hi
FROM g LEFT JOIN b USING ({names})"""


def _trend_bootstrap_sql(key_expr, key_name, extra=""):
    source = _HOURLY.strip().removeprefix("WITH hm AS (").removesuffix(")")
    return _bootstrap_sql(f"SELECT *, {key_expr} AS {key_name} FROM ({source})", [key_name, "event_type"], "value",
                          ["strftime(bucket, '%Y-%m-%d %H:%M:%S')", "event_type"], f"{key_name}, event_type{extra}")


@reg("group_mean_bootstrap", _bootstrap_sql(
    "SELECT * FROM orders", ["o_orderstatus", "o_orderpriority"], "o_totalprice", ["o_orderkey"], "o_orderstatus, o_orderpriority"))
def q_group_mean_bootstrap(spark, sf):
    return r6(C.group_mean_ci(table(spark, sf, "orders"), "o_orderstatus", "o_totalprice", hue="o_orderpriority",
                              row_key=["o_orderkey"]))


def _hourly_named(spark, sf):
    return _hourly(spark, sf).withColumn("hour", F.date_format("bucket", "yyyy-MM-dd HH:mm:ss"))


@reg("trend_daily_bootstrap", _trend_bootstrap_sql("strftime(bucket, '%Y-%m-%d')", "day"))
def q_trend_daily_bootstrap(spark, sf):
    return r6(C.trend_daily(_hourly_named(spark, sf), "bucket", "event_type", "value", row_key=["hour", "event_type"]))


@reg("trend_weekly_bootstrap", _trend_bootstrap_sql("strftime(date_trunc('week', bucket), '%Y-%m-%d')", "week_start"))
def q_trend_weekly_bootstrap(spark, sf):
    return r6(C.trend_weekly(_hourly_named(spark, sf), "bucket", "event_type", "value", row_key=["hour", "event_type"]))


@reg("trend_weekday_bootstrap", _trend_bootstrap_sql(
    "CAST(isodow(bucket) - 1 AS INTEGER)", "weekday",
    ", ['Monday', 'Tuesday', 'Wednesday', 'Thursday', 'Friday', 'Saturday', 'Sunday'][weekday + 1] AS weekday_name"))
def q_trend_weekday_bootstrap(spark, sf):
    return r6(C.trend_weekday(_hourly_named(spark, sf), "bucket", "event_type", "value", row_key=["hour", "event_type"]))


@reg("distinct_sorted", """
SELECT DISTINCT strftime(ts, '%Y-%m-%d') AS day FROM events ORDER BY 1""")
def q_distinct_sorted(spark, sf):
    ev = table(spark, sf, "events").select(F.date_format("ts", "yyyy-MM-dd").alias("day"))
    return C.distinct_sorted(ev, "day")


@reg("share_by_group", """
WITH g AS (SELECT l_returnflag, coalesce(sum(l_extendedprice), 0) AS total FROM lineitem
           WHERE l_returnflag IS NOT NULL GROUP BY 1)
SELECT l_returnflag, round(total, 6) AS total, round(total / sum(total) OVER (), 6) AS share FROM g""")
def q_share_by_group(spark, sf):
    return r6(C.share_by_group(table(spark, sf, "lineitem"), "l_returnflag", "l_extendedprice"))


def _hist_sql(tbl, g, v):
    return f"""
WITH base AS (SELECT {g} AS g, {v} AS v FROM {tbl} WHERE {g} IS NOT NULL AND {v} IS NOT NULL),
mm AS (SELECT CASE WHEN min(v) = max(v) THEN min(v) - 0.5 ELSE min(v) END AS lo,
              CASE WHEN min(v) = max(v) THEN max(v) + 0.5 ELSE max(v) END AS hi FROM base),
b AS (SELECT g, CAST(least(49, floor((v - lo) / ((hi - lo) / 50.0))) AS INTEGER) AS bin, lo, hi
      FROM base, mm)
SELECT g AS {g}, bin, count(*) AS n,
       round(any_value(lo) + bin * ((any_value(hi) - any_value(lo)) / 50.0), 6) AS bin_lo,
       round(any_value(lo) + (bin + 1) * ((any_value(hi) - any_value(lo)) / 50.0), 6) AS bin_hi
FROM b GROUP BY g, bin"""


@reg("stacked_histogram", _hist_sql("events", "event_type", "value"))
def q_stacked_histogram(spark, sf):
    return r6(C.stacked_histogram(table(spark, sf, "events"), "event_type", "value"))


@reg("stacked_histogram_lineitem", _hist_sql("lineitem", "l_returnflag", "l_extendedprice"))
def q_stacked_histogram_lineitem(spark, sf):
    return r6(C.stacked_histogram(table(spark, sf, "lineitem"), "l_returnflag", "l_extendedprice"))


@reg("box_stats", """
WITH long AS (
  SELECT l_returnflag, 'l_extendedprice' AS measure, l_extendedprice AS v FROM lineitem
  UNION ALL SELECT l_returnflag, 'l_quantity', l_quantity FROM lineitem),
base AS (SELECT * FROM long WHERE v IS NOT NULL AND l_returnflag IS NOT NULL),
q AS (SELECT l_returnflag, measure, count(*) AS n,
             quantile_cont(v, 0.25) AS q1, quantile_cont(v, 0.5) AS median,
             quantile_cont(v, 0.75) AS q3
      FROM base GROUP BY 1, 2),
f AS (SELECT *, q1 - 1.5 * (q3 - q1) AS lo, q3 + 1.5 * (q3 - q1) AS hi FROM q)
SELECT f.l_returnflag, f.measure, f.n, round(f.q1, 6) AS q1, round(f.median, 6) AS median,
       round(f.q3, 6) AS q3,
       round(least(f.q1, min(b.v) FILTER (WHERE b.v >= f.lo)), 6) AS whisker_lo,
       round(greatest(f.q3, max(b.v) FILTER (WHERE b.v <= f.hi)), 6) AS whisker_hi,
       count(*) FILTER (WHERE b.v < f.lo OR b.v > f.hi) AS n_outliers
FROM f JOIN base b USING (l_returnflag, measure)
GROUP BY f.l_returnflag, f.measure, f.n, f.q1, f.median, f.q3""")
def q_box_stats(spark, sf):
    return r6(C.box_stats(table(spark, sf, "lineitem"), "l_returnflag",
                          ["l_extendedprice", "l_quantity"]))


@reg("violin_density", """
WITH base AS (SELECT event_type AS g, value AS v FROM events
              WHERE event_type IS NOT NULL AND value IS NOT NULL),
s AS (SELECT g, count(*) AS n, stddev_samp(v) * pow(count(*), -0.2) AS h, min(v) AS mn, max(v) AS mx,
             quantile_cont(v, 0.25) AS q1, quantile_cont(v, 0.5) AS median, quantile_cont(v, 0.75) AS q3
      FROM base GROUP BY g),
grid AS (SELECT g, i AS grid_idx, (mn - 2 * h) + i * (((mx + 2 * h) - (mn - 2 * h)) / 99.0) AS grid_x, n, h
         FROM s, range(100) r(i) WHERE h > 0),
d AS (SELECT grid.g, grid_idx, any_value(grid_x) AS grid_x,
             sum(exp(-0.5 * pow((grid_x - v) / grid.h, 2))) / (any_value(grid.n) * any_value(grid.h) * sqrt(2 * pi())) AS density
      FROM grid JOIN base ON grid.g = base.g GROUP BY grid.g, grid_idx)
SELECT d.g AS event_type, CAST(grid_idx AS INTEGER) AS grid_idx, round(grid_x, 6) AS grid_x,
       round(density, 6) AS density, round(density / max(density) OVER (PARTITION BY d.g), 6) AS width,
       round(s.q1, 6) AS q1, round(s.median, 6) AS median, round(s.q3, 6) AS q3, s.n,
       round(s.h, 6) AS bandwidth
FROM d JOIN s ON d.g = s.g""")
def q_violin_density(spark, sf):
    return r6(C.violin_density(table(spark, sf, "events"), "event_type", "value"))


def _orders_cust(spark, sf):
    o = table(spark, sf, "orders")
    c = table(spark, sf, "customer")
    return o.join(c, o.o_custkey == c.c_custkey).select(
        "c_mktsegment", "o_totalprice", "o_orderdate",
        F.upper(F.date_format("o_orderdate", "MMMM")).alias("Month name"),
        F.weekofyear("o_orderdate").alias("Week no"))


@reg("month_pivot", """
WITH src AS (SELECT c_mktsegment, upper(monthname(o_orderdate)) AS mon, o_totalprice
             FROM orders JOIN customer ON o_custkey = c_custkey WHERE c_mktsegment IS NOT NULL),
p AS (SELECT c_mktsegment,
             coalesce(avg(o_totalprice) FILTER (WHERE mon = 'JANUARY'), 0) AS "JANUARY",
             coalesce(avg(o_totalprice) FILTER (WHERE mon = 'FEBRUARY'), 0) AS "FEBRUARY"
      FROM src GROUP BY 1),
ok AS (SELECT count(DISTINCT mon) = 2 AS both FROM src WHERE mon IN ('JANUARY', 'FEBRUARY'))
SELECT c_mktsegment, round("JANUARY", 6) AS "JANUARY", round("FEBRUARY", 6) AS "FEBRUARY",
       CASE WHEN "FEBRUARY" >= "JANUARY" THEN 'green' ELSE 'red' END AS color,
       round("FEBRUARY" / "JANUARY", 6) AS ratio,
       c_mktsegment || ': ' || format('{:,.2f}', CAST(trunc("JANUARY") AS BIGINT) / 1e6) || 'M' AS label_1,
       c_mktsegment || ': ' || format('{:,.2f}', CAST(trunc("FEBRUARY") AS BIGINT) / 1e6) || 'M' AS label_2
FROM p, ok WHERE ok.both AND "JANUARY" >= 150000 AND "FEBRUARY" >= 150000""")
def q_month_pivot(spark, sf):
    return r6(C.month_pivot(_orders_cust(spark, sf), "c_mktsegment", "o_totalprice",
                            "january", "february", threshold=150000))


@reg("month_week_mean", """
SELECT upper(monthname(o_orderdate)) AS "Month name", CAST(weekofyear(o_orderdate) AS INTEGER) AS "Week no",
       round(avg(o_totalprice), 6) AS mean
FROM orders JOIN customer ON o_custkey = c_custkey
WHERE c_mktsegment = 'BUILDING' GROUP BY 1, 2""")
def q_month_week_mean(spark, sf):
    return r6(C.month_week_mean(_orders_cust(spark, sf), "c_mktsegment", "building", "o_totalprice"))


@reg("scatter_points", """
SELECT round(l_quantity, 6) AS "l quantity", round(l_extendedprice, 6) AS "l extendedprice",
       l_returnflag AS "l returnflag", l_linestatus AS "l linestatus" FROM lineitem""")
def q_scatter_points(spark, sf):
    return r6(P.scatter_points(table(spark, sf, "lineitem"), "l_quantity", "l_extendedprice",
                               "l_returnflag", "l_linestatus"))


# Quantiles of a range of days from stored sketches; the base rows are read again here only to hold the
# ranks of what was found against the stated bound.
_RANGE = ("2024-01-05", "2024-01-20")


@reg("sketched_box", f"""
SELECT event_type, count(*) AS n, round(min(value), 6) AS smallest, round(max(value), 6) AS largest, CAST(p AS DOUBLE) AS p, true AS within_bound
FROM events, (VALUES (0.25), (0.5), (0.75)) AS t(p)
WHERE strftime(ts, '%Y-%m-%d') BETWEEN '{_RANGE[0]}' AND '{_RANGE[1]}' AND event_type IS NOT NULL AND value IS NOT NULL
GROUP BY event_type, p""")
def q_sketched_box(spark, sf):
    path = scratch_dir(spark, "sketches")
    ev = table(spark, sf, "events").withColumn("day", F.date_format("ts", "yyyy-MM-dd"))
    SK.store_sketches(SK.sketch_days(ev, "day", "event_type", "value"), path)
    box = SK.range_box(spark.read.parquet(path), *_RANGE)
    found = materialise(box.select(F.col("group").alias("event_type"), "n", "smallest", "largest", F.inline(F.array(*[
        F.struct(F.lit(p).alias("p"), F.col(c).alias("q")) for p, c in ((0.25, "q1"), (0.5, "median"), (0.75, "q3"))]))), "box")
    days = ev.filter(F.col("day").between(*_RANGE)).select("event_type", "value")
    ranks = days.join(found.select("event_type", "p", "q"), "event_type").groupBy("event_type", "p").agg(
        F.avg((F.col("value") < F.col("q")).cast("double")).alias("below"),
        F.avg((F.col("value") <= F.col("q")).cast("double")).alias("upto"))
    err = SK.rank_error()
    ok = (F.col("below") - err <= F.col("p")) & (F.col("upto") + err >= F.col("p"))
    return r6(found.join(ranks, ["event_type", "p"]).select("event_type", "n", "smallest", "largest", "p", ok.alias("within_bound")))
