"""Frame utilities, projections and filters (A13-A15, O*, U1, U3, W3, W7, P1-P5, P10, P11,
F1-F5) on driver tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.text import safe_name
from ..operators import clean as P
from ..operators import filters as FL
from ..operators import frames as FR
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


@reg("text_profile", """
WITH n AS (SELECT count(*) AS n FROM customer)
SELECT 1 AS position, 'c_custkey' AS column_name, 'int' AS type_class, CAST(NULL AS INTEGER) AS max_len, 'BIGINT' AS sql_type, n AS n_rows FROM n
UNION ALL SELECT 2, 'c_name', 'text', CAST(max(length(c_name)) AS INTEGER), 'VARCHAR(' || CAST(coalesce(max(length(c_name)), 0) + 100 AS VARCHAR) || ')', count(*) FROM customer
UNION ALL SELECT 3, 'c_nationkey', 'int', NULL, 'BIGINT', n FROM n
UNION ALL SELECT 4, 'c_acctbal', 'float', NULL, 'DECIMAL(32,10)', n FROM n
UNION ALL SELECT 5, 'c_mktsegment', 'text', CAST(max(length(c_mktsegment)) AS INTEGER), 'VARCHAR(' || CAST(coalesce(max(length(c_mktsegment)), 0) + 100 AS VARCHAR) || ')', count(*) FROM customer""")
def q_text_profile(spark, sf):
    return FR.text_profile(table(spark, sf, "customer"))


@reg("partition_by_key", """
SELECT coalesce(c_mktsegment, 'unknown') AS group_key, c_custkey, c_name, c_nationkey,
       round(c_acctbal, 6) AS c_acctbal, c_mktsegment FROM customer
UNION ALL
SELECT g, NULL, NULL, NULL, NULL, NULL FROM (VALUES ('AUTOMOBILE'), ('BUILDING'), ('NO_SEGMENT')) v(g)
WHERE g NOT IN (SELECT coalesce(c_mktsegment, 'unknown') FROM customer)""")
def q_partition_by_key(spark, sf):
    out = FR.partition_by_key(table(spark, sf, "customer"), "c_mktsegment", default="unknown",
                              guaranteed=["AUTOMOBILE", "BUILDING", "NO_SEGMENT"])
    return r6(out)


@reg("row_count", "SELECT count(*) AS n_rows FROM lineitem")
def q_row_count(spark, sf):
    return FR.row_count(table(spark, sf, "lineitem"))


@reg("preview", """
SELECT o_orderkey, o_custkey, round(o_totalprice, 6) AS o_totalprice, o_orderpriority FROM orders
ORDER BY o_totalprice DESC, o_orderkey LIMIT 10""")
def q_preview(spark, sf):
    o = table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_totalprice", "o_orderpriority")
    return r6(FR.preview(o, [F.col("o_totalprice").desc(), "o_orderkey"]))


@reg("site_id", "SELECT s_name AS site_id FROM supplier ORDER BY s_suppkey LIMIT 1")
def q_site_id(spark, sf):
    s = table(spark, sf, "supplier").withColumnRenamed("s_name", "Site_ID")
    return FR.site_id(s, ["s_suppkey"])


@reg("latest_run", """
SELECT o_orderstatus, max(strftime(o_orderdate, '%Y-%m-%d_%H%M%S') || '--' ||
       regexp_replace(regexp_replace(o_orderpriority, '^\\s+|\\s+$', '', 'g'), '[^0-9a-zA-Z]+', '_', 'g')) AS latest_run
FROM orders GROUP BY 1""")
def q_latest_run(spark, sf):
    o = table(spark, sf, "orders")
    runs = o.select("o_orderstatus", F.concat(F.date_format("o_orderdate", "yyyy-MM-dd_HHmmss"), F.lit("--"),
                                              safe_name("o_orderpriority")).alias("run"))
    return FR.latest_run(runs, "run", ["o_orderstatus"])


@reg("union_all", """
SELECT s_suppkey AS key, s_name AS name, round(s_acctbal, 6) AS bal, NULL AS segment FROM supplier
UNION ALL SELECT c_custkey, c_name, round(c_acctbal, 6), c_mktsegment FROM customer""")
def q_union_all(spark, sf):
    s = table(spark, sf, "supplier").select(F.col("s_suppkey").alias("key"), F.col("s_name").alias("name"),
                                            F.col("s_acctbal").alias("bal"))
    c = table(spark, sf, "customer").select(F.col("c_custkey").alias("key"), F.col("c_name").alias("name"),
                                            F.col("c_acctbal").alias("bal"), F.col("c_mktsegment").alias("segment"))
    return r6(FR.union_all([s, c]))


@reg("combine_scripts", """
WITH s AS (
  SELECT 'sys' || s_nationkey AS system, 'set' || s_suppkey // 1000 AS fileset, 'q' || lpad(CAST(s_suppkey AS VARCHAR), 9, '0') AS name,
         CASE WHEN s_suppkey % 2 = 0 THEN 'sql' ELSE 'bteq' END AS ext, s_suppkey,
         'SELECT ' || s_suppkey || ';' || chr(10) AS body FROM supplier)
SELECT system, fileset, ext, '!_' || system || '_' || fileset || '.combined.' || ext AS file,
       CASE WHEN max(CASE WHEN s_suppkey % 3 = 0 THEN 1 ELSE 0 END) = 1 THEN '/* prefix */' || chr(10) ELSE '' END
       || string_agg(body, '' ORDER BY name) AS text FROM s GROUP BY system, fileset, ext""")
def q_combine_scripts(spark, sf):
    # a fileset is a block of 1000 supplier keys, so a combined text is bounded; two extensions,
    # spelt differently, and a prefix that every third script carries
    s = table(spark, sf, "supplier").select(
        F.concat(F.lit("sys"), "s_nationkey").alias("system"),
        F.concat(F.lit("set"), F.floor(F.col("s_suppkey") / 1000)).alias("fileset"),
        F.concat(F.lit("q"), F.lpad(F.col("s_suppkey").cast("string"), 9, "0"), F.when(
            F.col("s_suppkey") % 2 == 0, ".SQL").otherwise(".bteq ")).alias("file"),
        F.concat(F.when(F.col("s_suppkey") % 3 == 0, "/* prefix */\n").otherwise(""), F.lit("SELECT "),
                 "s_suppkey", F.lit(";\n")).alias("text"))
    return FR.combine_scripts(s, prefix="/* prefix */\n").select("system", "fileset", "ext", "file", "text")


@reg("dedupe_names", """
WITH n AS (SELECT p_partkey, p_size, lower(p_type) || '.csv' AS name,
                  row_number() OVER (PARTITION BY lower(p_type) ORDER BY p_partkey) - 1 AS k FROM part)
SELECT p_partkey, p_size, name, CASE WHEN k = 0 THEN name
       ELSE substr(name, 1, length(name) - 4) || printf('.%03d', k) || right(name, 4) END AS file_name FROM n""")
def q_dedupe_names(spark, sf):
    p = table(spark, sf, "part").select("p_partkey", "p_size", F.concat(F.lower("p_type"), F.lit(".csv")).alias("name"))
    return FR.dedupe_names(p, "name", "p_partkey")


@reg("row_chunks", """
SELECT l_orderkey, l_linenumber, l_returnflag, row_number() OVER (ORDER BY l_orderkey, l_linenumber, l_partkey, l_suppkey) AS row_no,
       CAST(floor((row_number() OVER (ORDER BY l_orderkey, l_linenumber, l_partkey, l_suppkey) - 1) / 100) + 1 AS BIGINT) AS chunk
FROM lineitem""")
def q_row_chunks(spark, sf):
    li = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_returnflag")
    order = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]
    return FR.row_chunks(li, order, size=100).drop("l_partkey", "l_suppkey")


@reg("script_order", """
SELECT 'p' || lpad(CAST(p_partkey AS VARCHAR), 6, '0') || '.q.sql' AS file FROM part ORDER BY 1""")
def q_script_order(spark, sf):
    p = table(spark, sf, "part").select(F.concat(F.lit("p"), F.lpad(F.col("p_partkey").cast("string"), 6, "0"),
                                                 F.lit(".q.sql")).alias("file"))
    return p.orderBy("file")


_CUST_SQL = "c_custkey, c_name, c_nationkey, round(c_acctbal, 6) AS c_acctbal, c_mktsegment"


@reg("drop_unnamed", f"SELECT {_CUST_SQL} FROM customer")
def q_drop_unnamed(spark, sf):
    c = table(spark, sf, "customer")
    c = c.select(F.lit(0).alias("_c0"), F.col("c_custkey").alias("Unnamed: 1"), "*")
    return r6(P.drop_unnamed(c))


@reg("keep_columns", "SELECT l_orderkey, l_linenumber, round(l_quantity, 6) AS l_quantity FROM lineitem")
def q_keep_columns(spark, sf):
    li = table(spark, sf, "lineitem")
    return r6(P.keep_columns(li, index=["L_ORDERKEY"], data=["l_linenumber", "L_QUANTITY"]))


@reg("humanise_columns", """
SELECT event_id AS "Event Count", round(value, 6) AS "Value Average Seconds", event_type AS "event type"
FROM events""")
def q_humanise_columns(spark, sf):
    e = table(spark, sf, "events").select(F.col("event_id").alias("Event_Cnt"),
                                          F.col("value").alias("Value_Avg_Sec"), "event_type")
    return r6(P.humanise_columns(e))


@reg("trim_all", """
SELECT c_custkey, c_name, c_mktsegment FROM customer""")
def q_trim_all(spark, sf):
    c = table(spark, sf, "customer").select(
        F.col("c_custkey").alias(" c_custkey"),
        F.concat(F.lit("  "), F.col("c_name"), F.lit("\t")).alias("c_name "),
        F.concat(F.lit("\n"), F.col("c_mktsegment"), F.lit(" ")).alias("\tc_mktsegment"))
    return P.trim_all(c)


@reg("stringify", """
SELECT c_custkey, coalesce(CASE WHEN c_acctbal < 0 THEN NULL ELSE c_mktsegment END, 'nan') AS seg FROM customer""")
def q_stringify(spark, sf):
    c = table(spark, sf, "customer").select(
        "c_custkey", F.when(F.col("c_acctbal") < 0, None).otherwise(F.col("c_mktsegment")).alias("seg"))
    return P.stringify(c, null_text="nan")


@reg("decimal_to_double", """
SELECT l_orderkey, l_linenumber, round(CAST(CAST(l_extendedprice AS DECIMAL(18, 2)) AS DOUBLE), 6) AS price FROM lineitem""")
def q_decimal_to_double(spark, sf):
    li = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber",
                                             F.col("l_extendedprice").cast("decimal(18,2)").alias("price"))
    return r6(P.decimal_to_double(li))


@reg("nan_to_null", """
SELECT event_id, round(CASE WHEN value > 400 THEN NULL ELSE value END, 6) AS value FROM events""")
def q_nan_to_null(spark, sf):
    e = table(spark, sf, "events").select(
        "event_id", F.when(F.col("value") > 400, F.lit(float("nan"))).otherwise(F.col("value")).alias("value"))
    return r6(P.nan_to_null(e))


def _sys_active():
    return F.when(F.col("s_acctbal") >= 0, "True").when(F.col("s_acctbal") < -500, None).otherwise("false")


@reg("active_only", """
SELECT s_name AS system FROM supplier
WHERE lower(coalesce(CASE WHEN s_acctbal >= 0 THEN 'True' WHEN s_acctbal < -500 THEN NULL ELSE 'false' END, 'True')) = 'true'""")
def q_active_only(spark, sf):
    s = table(spark, sf, "supplier").select(F.col("s_name").alias("system"), _sys_active().alias("active"))
    return FL.active_only(s).select("system")


@reg("version_match", """
WITH f AS (SELECT p_partkey,
  CASE WHEN p_size < 10 THEN NULL ELSE ['v' || CAST(p_size % 3 AS VARCHAR), 'v9'] END AS versions,
  CASE WHEN p_size > 40 THEN NULL ELSE [p_type] END AS collections FROM part)
SELECT p_partkey FROM f
WHERE coalesce(list_contains(versions, 'v1'), true) AND coalesce(list_contains(collections, 'SMALL'), true)""")
def q_version_match(spark, sf):
    p = table(spark, sf, "part").select(
        "p_partkey",
        F.when(F.col("p_size") < 10, None).otherwise(
            F.array(F.concat(F.lit("v"), (F.col("p_size") % 3).cast("string")), F.lit("v9"))).alias("versions"),
        F.when(F.col("p_size") > 40, None).otherwise(F.array("p_type")).alias("collections"),
        F.lit("v1").alias("version"), F.lit("SMALL").alias("collection"))
    return FL.version_match(p, "versions", "version", "collections", "collection").select("p_partkey")


@reg("group_value_filter", """
SELECT o_orderkey, o_orderpriority FROM orders WHERE o_orderpriority = upper('1-urgent')""")
def q_group_value_filter(spark, sf):
    o = table(spark, sf, "orders").select("o_orderkey", "o_orderpriority")
    return FL.group_value_filter(o, "o_orderpriority", "1-urgent")


@reg("both_over_threshold", """
SELECT c_custkey FROM customer WHERE c_acctbal >= 1000 AND c_acctbal * 2 - 3000 >= 1000""")
def q_both_over_threshold(spark, sf):
    c = table(spark, sf, "customer").select("c_custkey", F.col("c_acctbal").alias("m1"),
                                            (F.col("c_acctbal") * 2 - 3000).alias("m2"))
    return FL.both_over_threshold(c, "m1", "m2", 1000).select("c_custkey")


@reg("name_regex_filter", """
SELECT p_partkey, p_name FROM part WHERE regexp_matches(p_name, 'ring|bolt$')""")
def q_name_regex_filter(spark, sf):
    p = table(spark, sf, "part").select("p_partkey", "p_name")
    return FL.name_regex_filter(p, "p_name", "ring|bolt$")
