"""Script preparation (T2, T6, W6, J4 and the prepare composite) on scripts built from
supplier rows (one script per supplier), includes from region rows and loop parameters from
nation rows: the fan-out is five parameter rows per script, so the work grows with supplier."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import template as TP
from ..plans import jobs
from .tables import table

Q: dict = {}
SQL: dict = {}


def reg(name, sql=None):
    def deco(fn):
        Q[name] = fn
        if sql is not None:
            SQL[name] = sql
        return fn
    return deco


def scripts(spark, sf):
    s = table(spark, sf, "supplier")
    k = (F.col("s_nationkey") % 5).cast("string")
    text = F.concat(
        F.lit("SELECT 1 AS a /*{{save:"), F.lower("s_name"), F.lit(".csv}}*/;\n ; "),
        F.lit("SELECT '{x}' AS b /*{{file:inc_"), k, F.lit(".sql}}*/;"),
        F.lit("SELECT '{n_name}' AS c, {n_nationkey} AS k /*{{loop:nation_r"), k, F.lit("}}*/ ; "))
    return s.select(F.col("s_name").alias("system"), text.alias("text"))


def library(spark, sf):
    r = table(spark, sf, "region")
    return r.filter(F.col("r_regionkey") < 4).select(
        F.concat(F.lit("inc_"), F.col("r_regionkey").cast("string"), F.lit(".sql")).alias("name"),
        F.concat(F.lit("SELECT '"), F.col("r_name"), F.lit("' AS region")).alias("body"))


def loop_params(spark, sf):
    n = table(spark, sf, "nation")
    return n.select(F.concat(F.lit("nation_r"), F.col("n_regionkey").cast("string")).alias("file"),
                    "n_name", "n_nationkey")


_SCRIPTS_SQL = """
WITH scripts AS (
  SELECT s_name AS system,
    'SELECT 1 AS a /*{{save:' || lower(s_name) || '.csv}}*/;' || chr(10) || ' ; ' ||
    'SELECT ''{x}'' AS b /*{{file:inc_' || CAST(s_nationkey % 5 AS VARCHAR) || '.sql}}*/;' ||
    'SELECT ''{n_name}'' AS c, {n_nationkey} AS k /*{{loop:nation_r' || CAST(s_nationkey % 5 AS VARCHAR) || '}}*/ ; ' AS text
  FROM supplier),
fmt AS (
  SELECT system, list_filter(list_transform(string_split(text, ';'), lambda p:
      CASE WHEN regexp_replace(regexp_replace(p, '^\\s+|\\s+$', '', 'g'), '\\n\\n+', chr(10), 'g') = '' THEN ''
           ELSE regexp_replace(regexp_replace(p, '^\\s+|\\s+$', '', 'g'), '\\n\\n+', chr(10), 'g')
                || chr(10) || ';' || chr(10) || chr(10) END), lambda s: s <> '') AS stmts
  FROM scripts),
stmts AS (
  SELECT system, CAST(generate_subscripts(stmts, 1) AS INTEGER) AS stmt_no, unnest(stmts) AS sql FROM fmt),
marked AS (
  SELECT system, stmt_no,
    regexp_replace(sql, '/\\*\\{\\{\\s*(file|temp|loop)\\s*:[^}]*\\}\\}\\*/', '/* {{replaceMe:\\1}} */', 'g') AS sql,
    regexp_extract(sql, '/\\*\\{\\{\\s*file\\s*:\\s*([^}]*?)\\s*\\}\\}\\*/', 1) AS file_ref,
    regexp_extract(sql, '/\\*\\{\\{\\s*loop\\s*:\\s*([^}]*?)\\s*\\}\\}\\*/', 1) AS loop_ref
  FROM stmts),
library AS (
  SELECT 'inc_' || CAST(r_regionkey AS VARCHAR) || '.sql' AS name, 'SELECT ''' || r_name || ''' AS region' AS body
  FROM region WHERE r_regionkey < 4),
included AS (
  SELECT m.system, m.stmt_no, 0 AS sub_no, '/* BEGIN file insert: ' || l.name || ' */ ' || chr(10) || l.body AS sql,
         'ok' AS status, '' AS loop_ref
  FROM marked m JOIN library l ON m.file_ref = l.name
  UNION ALL
  SELECT m.system, m.stmt_no, 1,
    CASE WHEN l.name IS NOT NULL THEN replace(m.sql, '{{replaceMe:file}}', 'END file insert: ' || l.name) ELSE m.sql END,
    CASE WHEN m.file_ref <> '' AND l.name IS NULL THEN 'warning: file missing' ELSE 'ok' END, m.loop_ref
  FROM marked m LEFT JOIN library l ON m.file_ref = l.name)
"""


@reg("split_statements", """
WITH scripts AS (
  SELECT s_name AS system,
    'SELECT 1 AS a /*{{save:' || lower(s_name) || '.csv}}*/;' || chr(10) || ' ; ' ||
    'SELECT ''{x}'' AS b /*{{file:inc_' || CAST(s_nationkey % 5 AS VARCHAR) || '.sql}}*/;' ||
    'SELECT ''{n_name}'' AS c, {n_nationkey} AS k /*{{loop:nation_r' || CAST(s_nationkey % 5 AS VARCHAR) || '}}*/ ; ' AS text
  FROM supplier)
SELECT system, CAST(generate_subscripts(string_split(text, ';'), 1) AS INTEGER) AS stmt_no,
       unnest(string_split(text, ';')) AS raw FROM scripts""")
def q_split_statements(spark, sf):
    return TP.split_statements(scripts(spark, sf), ["system"])


@reg("statement_number", _SCRIPTS_SQL + "SELECT system, stmt_no, sql FROM stmts")
def q_statement_number(spark, sf):
    return TP.formatted_statements(scripts(spark, sf), ["system"])


@reg("include_text", _SCRIPTS_SQL + "SELECT system, stmt_no, sub_no, sql, status FROM included")
def q_include_text(spark, sf):
    st = TP.with_directives(TP.formatted_statements(scripts(spark, sf), ["system"]))
    return TP.include_files(st, library(spark, sf), ["system"])


@reg("param_fanout", _SCRIPTS_SQL + """
, prm AS (SELECT 'nation_r' || CAST(n_regionkey AS VARCHAR) AS file, n_name, n_nationkey,
                 row_number() OVER (PARTITION BY n_regionkey ORDER BY n_nationkey) AS row_no,
                 count(*) OVER (PARTITION BY n_regionkey) AS n_rows FROM nation)
SELECT m.system, m.stmt_no, p.row_no,
  replace(replace(replace(m.sql, '{n_name}', p.n_name), '{n_nationkey}', CAST(p.n_nationkey AS VARCHAR)),
          '{{replaceMe:loop}}', ' csv row ' || CAST(p.row_no AS VARCHAR) || ' out of ' || CAST(p.n_rows AS VARCHAR) || ' ') AS sql
FROM marked m JOIN prm p ON m.loop_ref = p.file""")
def q_param_fanout(spark, sf):
    st = TP.with_directives(TP.formatted_statements(scripts(spark, sf), ["system"]))
    loops = st.withColumn("loop_file", TP.first_loop()["value"]) \
        .filter(F.col("loop_file").isNotNull()).select("system", "stmt_no", "sql", "loop_file")
    rows = TP.param_rows(loop_params(spark, sf), "file", ["n_nationkey"])
    return TP.param_fanout(loops, rows).select("system", "stmt_no", "row_no", "sql")


@reg("prepare_scripts", _SCRIPTS_SQL + """
, prm AS (SELECT 'nation_r' || CAST(n_regionkey AS VARCHAR) AS file, n_name, n_nationkey,
                 row_number() OVER (PARTITION BY n_regionkey ORDER BY n_nationkey) AS row_no,
                 count(*) OVER (PARTITION BY n_regionkey) AS n_rows FROM nation)
SELECT i.system, 'set' AS fileset, 'main.sql' AS file, i.stmt_no, i.sub_no, CAST(0 AS BIGINT) AS row_no,
  replace(i.sql, '{x}', lower(i.system)) AS sql, i.status FROM included i WHERE i.loop_ref = ''
UNION ALL
SELECT i.system, 'set', 'main.sql', i.stmt_no, i.sub_no, p.row_no,
  replace(replace(replace(i.sql, '{n_name}', p.n_name), '{n_nationkey}', CAST(p.n_nationkey AS VARCHAR)),
          '{{replaceMe:loop}}', ' csv row ' || CAST(p.row_no AS VARCHAR) || ' out of ' || CAST(p.n_rows AS VARCHAR) || ' '),
  i.status
FROM included i JOIN prm p ON i.loop_ref = p.file""")
def q_prepare_scripts(spark, sf):
    keys = ["system", "fileset", "file"]
    src = scripts(spark, sf).withColumns({"fileset": F.lit("set"), "file": F.lit("main.sql")})
    values = src.select(*keys, F.array(F.struct(
        F.lit(1).alias("priority"), F.lit(0).alias("pos"), F.lit("x").alias("k"), F.lower("system").alias("v"))).alias("pairs"))
    out = jobs.prepare_scripts(src, keys, substitutions=values, library=library(spark, sf),
                               loop_params=loop_params(spark, sf), loop_order=["n_nationkey"])
    return out.select(*keys, "stmt_no", "sub_no", "row_no", "sql", "status")
