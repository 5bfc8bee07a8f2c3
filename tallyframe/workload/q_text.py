"""Scalar functions (T1, T3-T5, T8-T17, T19-T21) applied to driver-table columns."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import text as X
from ..operators import secret_table as SE
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


def _duck_strip(e: str) -> str:
    return f"regexp_replace({e}, '^\\s+|\\s+$', '', 'g')"


# Ordered substitution; "greeting" holds placeholders resolved by later keys.
_TEMPLATE = "SELECT '{greeting}' AS g, {key} AS k, '{region}' AS r"


@reg("substitute", """
SELECT s_suppkey,
  replace(replace(replace(replace('SELECT ''{greeting}'' AS g, {key} AS k, ''{region}'' AS r',
    '{greeting}', 'Hello {name} of {region}'), '{name}', s_name), '{region}', r_name),
    '{key}', CAST(s_suppkey AS VARCHAR)) AS sql
FROM supplier JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey""")
def q_substitute(spark, sf):
    s, n, r = table(spark, sf, "supplier"), table(spark, sf, "nation"), table(spark, sf, "region")
    j = s.join(n, s.s_nationkey == n.n_nationkey).join(r, n.n_regionkey == r.r_regionkey)
    pairs = [("greeting", "Hello {name} of {region}"), ("name", F.col("s_name")),
             ("region", F.col("r_name")), ("key", F.col("s_suppkey"))]
    return j.select("s_suppkey", X.substitute(F.lit(_TEMPLATE), pairs).alias("sql"))


def _stmt_text_spark():
    nl = F.lit("\n")
    return F.concat(F.lit("  SELECT "), F.col("p_size").cast("string"), F.lit(" AS size"), nl, nl, nl,
                    F.lit("  FROM part"), nl, nl, F.lit(" WHERE p_brand = '"), F.col("p_brand"),
                    F.lit("'  ;  tail "), F.col("p_name"))


_STMT_TEXT_SQL = ("'  SELECT ' || CAST(p_size AS VARCHAR) || ' AS size' || chr(10) || chr(10) || chr(10)"
                  " || '  FROM part' || chr(10) || chr(10) || ' WHERE p_brand = ''' || p_brand"
                  " || '''  ;  tail ' || p_name")


@reg("format_statement", f"""
WITH s AS (SELECT p_partkey,
  regexp_replace({_duck_strip(f"split_part({_STMT_TEXT_SQL}, ';', 1)")}, '\\n\\n+', chr(10), 'g') AS b
  FROM part)
SELECT p_partkey, CASE WHEN b = '' THEN '' ELSE b || chr(10) || ';' || chr(10) || chr(10) END AS sql FROM s""")
def q_format_statement(spark, sf):
    return table(spark, sf, "part").select(
        "p_partkey", X.format_statement(_stmt_text_spark()).alias("sql"))


def _directive_text_spark():
    return F.concat(F.lit("/*{{save: out_"), F.col("p_partkey").cast("string"),
                    F.lit(".csv}}*/ SELECT 1 /*{{ loop : p"), F.col("p_size").cast("string"),
                    F.lit(" }}*/ FROM t /*{{bad:a:b}}*/ -- "), F.col("p_name"))


_DIRECTIVE_TEXT_SQL = ("'/*{{save: out_' || CAST(p_partkey AS VARCHAR) || '.csv}}*/ SELECT 1 /*{{ loop : p'"
                       " || CAST(p_size AS VARCHAR) || ' }}*/ FROM t /*{{bad:a:b}}*/ -- ' || p_name")


@reg("extract_directives", f"""
WITH m AS (SELECT p_partkey, regexp_extract_all({_DIRECTIVE_TEXT_SQL}, '(?s)/\\*\\{{\\{{(.*?)\\}}\\}}\\*/', 1) AS b
           FROM part),
u AS (SELECT p_partkey, unnest(b) AS body, generate_subscripts(b, 1) AS d_no FROM m)
SELECT p_partkey, CAST(d_no AS INTEGER) AS d_no,
       {_duck_strip("string_split(body, ':')[1]")} AS key,
       CASE WHEN len(string_split(body, ':')) = 2 THEN {_duck_strip("string_split(body, ':')[2]")} ELSE '' END AS value
FROM u""")
def q_extract_directives(spark, sf):
    p = table(spark, sf, "part").select("p_partkey", X.directive_matches(_directive_text_spark()).alias("m"))
    return p.select("p_partkey", F.posexplode("m").alias("pos", "d")).select(
        "p_partkey", (F.col("pos") + 1).alias("d_no"), F.col("d.key").alias("key"),
        F.col("d.value").alias("value"))


@reg("strip_directives", f"""
SELECT p_partkey,
  regexp_replace({_DIRECTIVE_TEXT_SQL}, '/\\*\\{{\\{{ ?(loop|bad)[^}}]*\\}}\\}}\\*/',
                 '/* note */', 'g') AS sql
FROM part""")
def q_strip_directives(spark, sf):
    return table(spark, sf, "part").select(
        "p_partkey", X.strip_directives(_directive_text_spark(), skip=["save"],
                                        put=lambda key, value: F.lit("/* note */")).alias("sql"))


@reg("last_directive_wins", f"""
WITH m AS (SELECT p_partkey, regexp_extract_all(
    '/*{{{{k:first}}}}*/ /*{{{{k: ' || p_type || ' }}}}*/ /*{{{{j:' || CAST(p_size AS VARCHAR) || '}}}}*/',
    '(?s)/\\*\\{{\\{{(.*?)\\}}\\}}\\*/', 1) AS b FROM part)
SELECT p_partkey, {_duck_strip("string_split(b[2], ':')[2]")} AS k_value,
       {_duck_strip("string_split(b[3], ':')[2]")} AS j_value FROM m""")
def q_last_directive_wins(spark, sf):
    t = F.concat(F.lit("/*{{k:first}}*/ /*{{k: "), F.col("p_type"), F.lit(" }}*/ /*{{j:"),
                 F.col("p_size").cast("string"), F.lit("}}*/"))
    d = table(spark, sf, "part").select("p_partkey", X.directives(t).alias("d"))
    return d.select("p_partkey", F.col("d")["k"].alias("k_value"), F.col("d")["j"].alias("j_value"))


_KINDS = ["FILE_x", "temp1", "Loop", "save", "SAVE", "vis", "pptx", "call", "load", "other"]
_KINDS_SQL = "[" + ", ".join(f"'{k}'" for k in _KINDS) + "]"


@reg("directive_kind", f"""
WITH k AS (SELECT p_partkey, {_KINDS_SQL}[(p_size % 10) + 1] AS key FROM part)
SELECT p_partkey, key,
  CASE WHEN lower(substr(key, 1, 4)) = 'file' THEN 'file'
       WHEN lower(substr(key, 1, 4)) = 'temp' THEN 'temp'
       WHEN lower(substr(key, 1, 4)) = 'loop' THEN 'loop'
       WHEN key IN ('save', 'load', 'call', 'vis', 'pptx') THEN key
       ELSE 'other' END AS kind
FROM k""")
def q_directive_kind(spark, sf):
    keys = F.element_at(F.array(*[F.lit(k) for k in _KINDS]), (F.col("p_size") % 10) + 1)
    p = table(spark, sf, "part").select("p_partkey", keys.alias("key"))
    return p.withColumn("kind", X.directive_kind("key"))


@reg("humanise_name", """
SELECT p_partkey, 'Concurrency_' || p_type || '_Avg_Cnt_Sec_80Pctl_95Pctl_' || p_brand AS name,
       'Concurrency, ' || p_type || ' Average Count Seconds 80th Percentile 95th Percentile ' || p_brand AS human FROM part""")
def q_humanise_name(spark, sf):
    p = table(spark, sf, "part").select("p_partkey", F.concat(
        F.lit("Concurrency_"), F.col("p_type"), F.lit("_Avg_Cnt_Sec_80Pctl_95Pctl_"), F.col("p_brand")).alias("name"))
    return p.withColumn("human", X.humanise_name("name"))


_TITLE_KEYS = ["Concurrency, Average", "Concurrency_80Pctl", "Concurrency_95Pctl", "Concurrency_Peak",
               "Concurrency_Max"]


@reg("measure_title", """
SELECT p_partkey,
  ['Concurrency, Average', 'Concurrency_80Pctl', 'Concurrency_95Pctl', 'Concurrency_Peak', 'Concurrency_Max'][(p_size % 5) + 1] AS measure,
  ['Concurrency, Average', 'Concurrency, 80th Percentile', 'Concurrency, 95th Percentile', 'Concurrency, Peak', 'Concurrency'][(p_size % 5) + 1] AS title
FROM part""")
def q_measure_title(spark, sf):
    m = F.element_at(F.array(*[F.lit(k) for k in _TITLE_KEYS]), (F.col("p_size") % 5) + 1)
    p = table(spark, sf, "part").select("p_partkey", m.alias("measure"))
    return p.withColumn("title", X.measure_title("measure"))


def _abbr_sql(x):
    return (f"CASE WHEN {x} >= 1e9 THEN format('{{:,.1f}}', {x} / 1e9) || ' B' "
            f"WHEN {x} >= 1e6 THEN format('{{:,.1f}}', {x} / 1e6) || ' M' "
            f"WHEN {x} >= 1e3 THEN format('{{:,.1f}}', {x} / 1e3) || ' k' "
            f"WHEN {x} >= 0 THEN format('{{:,.0f}}', {x}) ELSE CAST({x} AS VARCHAR) END")


@reg("abbreviate_number", f"""
SELECT o_orderkey, {_abbr_sql("o_totalprice")} AS a_price, {_abbr_sql("o_totalprice * o_totalprice / 10")} AS a_square,
       {_abbr_sql("o_totalprice / 1000")} AS a_small, {_abbr_sql("o_totalprice * 30")} AS a_mid
FROM orders""")
def q_abbreviate_number(spark, sf):
    o = table(spark, sf, "orders")
    p = F.col("o_totalprice")
    return o.select("o_orderkey", X.abbreviate_number(p).alias("a_price"),
                    X.abbreviate_number(p * p / 10).alias("a_square"),
                    X.abbreviate_number(p / 1000).alias("a_small"),
                    X.abbreviate_number(p * 30).alias("a_mid"))


@reg("millions_label", """
SELECT o_orderkey, o_orderpriority || ': ' || format('{:,.2f}', CAST(trunc(o_totalprice * 100) AS BIGINT) / 1e6) || 'M' AS label
FROM orders""")
def q_millions_label(spark, sf):
    o = table(spark, sf, "orders")
    return o.select("o_orderkey", X.millions_label("o_orderpriority", F.col("o_totalprice") * 100).alias("label"))


@reg("classify_change", """
SELECT c_custkey, CASE WHEN c_acctbal * 1.1 - 500 >= c_acctbal THEN 'green' ELSE 'red' END AS color FROM customer""")
def q_classify_change(spark, sf):
    c = table(spark, sf, "customer")
    return c.select("c_custkey", X.classify_change("c_acctbal", F.col("c_acctbal") * 1.1 - 500).alias("color"))


# Fixed example secret list (order matters: masks apply in list order).
SECRETS = ["example.com", "token", "mail3", "ab", "x"]


@reg("mask_secrets", """
SELECT doc_id, replace(replace(replace(replace(text, 'example.com', 'e*********m'), 'token', 't***n'), 'mail3', 'm***3'),
                       'x', 'xx') AS text FROM documents""")
def q_mask_secrets(spark, sf):
    d = table(spark, sf, "documents")
    return d.select("doc_id", X.mask_secrets("text", SECRETS).alias("text"))


@reg("safe_name", f"""
SELECT o_orderkey,
  regexp_replace({_duck_strip("o_orderpriority || ' / ' || o_orderstatus")}, '[^0-9a-zA-Z]+', '_', 'g') AS safe,
  strftime(o_orderdate, '%Y-%m-%d_%H%M%S') || '--' ||
    regexp_replace({_duck_strip("o_orderpriority")}, '[^0-9a-zA-Z]+', '_', 'g') AS run_folder
FROM orders""")
def q_safe_name(spark, sf):
    o = table(spark, sf, "orders")
    return o.select("o_orderkey",
                    X.safe_name(F.concat_ws(" / ", "o_orderpriority", "o_orderstatus")).alias("safe"),
                    X.run_folder_name("o_orderdate", F.col("o_orderpriority")).alias("run_folder"))


@reg("date_keys", """
SELECT o_orderkey, strftime(o_orderdate, '%Y%m%d') AS yyyymmdd, strftime(o_orderdate, '%Y%m') AS yyyymm,
       strftime(o_orderdate, '%m%d%Y%H%M') AS run_id FROM orders""")
def q_date_keys(spark, sf):
    o = table(spark, sf, "orders")
    return o.select("o_orderkey", X.date_keys("o_orderdate").alias("k")).select("o_orderkey", "k.*")


_BOOLS = [" True", "false ", "TRUE", "yes", "1", "t", "False\t", "maybe"]


@reg("parse_boolean", f"""
WITH b AS (SELECT p_partkey, [' True', 'false ', 'TRUE', 'yes', '1', 't', 'False' || chr(9), 'maybe'][(p_size % 8) + 1] AS raw
           FROM part)
SELECT p_partkey, raw, CASE lower({_duck_strip("raw")}) WHEN 'true' THEN true WHEN 'false' THEN false END AS flag
FROM b""")
def q_parse_boolean(spark, sf):
    raw = F.element_at(F.array(*[F.lit(b) for b in _BOOLS]), (F.col("p_size") % 8) + 1)
    p = table(spark, sf, "part").select("p_partkey", raw.alias("raw"))
    return p.withColumn("flag", X.parse_boolean("raw"))


@reg("bool_text", """
SELECT p_partkey, CASE WHEN p_size > 25 THEN 'True' ELSE 'False' END AS big FROM part""")
def q_bool_text(spark, sf):
    p = table(spark, sf, "part")
    return p.select("p_partkey", X.bool_text(F.col("p_size") > 25).alias("big"))


@reg("split_table_ref", """
WITH r AS (SELECT s_suppkey, CASE WHEN s_nationkey < 10 THEN lower(s_name)
                                  ELSE 'sch' || CAST(s_nationkey AS VARCHAR) || '.' || lower(s_name) END AS ref
           FROM supplier)
SELECT s_suppkey, ref,
       CASE WHEN len(string_split(ref, '.')) >= 2 THEN string_split(ref, '.')[1] ELSE 'dflt' END AS schema_name,
       CASE WHEN len(string_split(ref, '.')) >= 2 THEN string_split(ref, '.')[2] ELSE ref END AS table_name
FROM r""")
def q_split_table_ref(spark, sf):
    sp = table(spark, sf, "supplier")
    ref = F.when(F.col("s_nationkey") < 10, F.lower("s_name")).otherwise(
        F.concat(F.lit("sch"), F.col("s_nationkey").cast("string"), F.lit("."), F.lower("s_name")))
    s = sp.select("s_suppkey", ref.alias("ref"))
    t = X.split_table_ref("ref", "dflt")
    return s.select("s_suppkey", "ref", t["schema"].alias("schema_name"), t["table"].alias("table_name"))


@reg("pad_array", """
WITH a AS (SELECT p_partkey, string_split(p_type || ' ' || p_brand, ' ') AS arr, p_size % 6 AS w FROM part),
p AS (SELECT p_partkey, CASE WHEN w > len(arr) THEN list_concat(arr, list_resize([]::VARCHAR[], w - len(arr), 'x'))
                             ELSE arr END AS padded FROM a)
SELECT p_partkey, array_to_string(padded, '|') AS padded, CAST(len(padded) AS INTEGER) AS width FROM p""")
def q_pad_array(spark, sf):
    p = table(spark, sf, "part")
    arr = F.split(F.concat_ws(" ", "p_type", "p_brand"), " ")
    padded = X.pad_array(arr, F.col("p_size") % 6, "x")
    return p.select("p_partkey", F.array_join(padded, "|").alias("padded"), F.size(padded).alias("width"))


@reg("to_key_value", """
WITH a AS (SELECT p_partkey, list_distinct(string_split(p_type || ' ' || p_brand || ' ' || p_type, ' ')) AS arr FROM part)
SELECT p_partkey, array_to_string(list_sort(arr), '|') AS keys,
       array_to_string(list_sort(arr), '|') AS vals, CAST(len(arr) * 2 AS INTEGER) AS n_both FROM a""")
def q_to_key_value(spark, sf):
    p = table(spark, sf, "part")
    arr = F.array_distinct(F.split(F.concat_ws(" ", "p_type", "p_brand", "p_type"), " "))
    m = X.list_to_map(arr)
    return p.select("p_partkey",
                    F.array_join(F.array_sort(X.map_to_list(m, "keys")), "|").alias("keys"),
                    F.array_join(F.array_sort(X.map_to_list(m, "values")), "|").alias("vals"),
                    F.size(X.map_to_list(m, "both")).alias("n_both"))


@reg("normalise_category", """
SELECT o_orderkey, replace(upper(o_orderpriority || '_' || o_orderstatus), '_', ' ') AS category FROM orders""")
def q_normalise_category(spark, sf):
    from ..operators.clean import normalise_category
    o = table(spark, sf, "orders").select("o_orderkey", F.concat_ws("_", "o_orderpriority", "o_orderstatus").alias("category"))
    return normalise_category(o, ["category"])


_ = r6


# Secrets from tables: the words of the benchmark and all customers' names, in the order of their text.
@reg("mask_secret_table", """
WITH s AS (SELECT DISTINCT w AS secret FROM (SELECT unnest(string_split(text, ' ')) AS w FROM benchmark) WHERE length(w) >= 5
  UNION SELECT c_name FROM customer),
l AS (SELECT list(secret ORDER BY secret) AS secrets FROM s)
SELECT doc_id, list_reduce([text] || secrets, lambda acc, s: replace(acc, s, s[1] || repeat('*', length(s) - 2) || s[-1])) AS text
FROM documents, l""")
def q_mask_secret_table(spark, sf):
    words = table(spark, sf, "benchmark").select(F.explode(F.split("text", " ")).alias("secret")).filter("length(secret) >= 5")
    secrets = words.unionByName(table(spark, sf, "customer").select(F.col("c_name").alias("secret"))).distinct()
    docs = table(spark, sf, "documents").select("doc_id", "text")
    return SE.mask_by_table(docs, secrets.withColumn("pos", F.lit(0)))
