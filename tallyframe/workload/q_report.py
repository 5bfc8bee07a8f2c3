"""Report binding (T7, J6, J7, fill_report): template items built from supplier rows (one
text item and two table cells per supplier), data cells from the region table rendered as its
CSV cell grid (the lookup side)."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..operators import report as RP
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


def items(spark, sf):
    s = table(spark, sf, "supplier")
    r1 = (F.col("s_nationkey") % 5 + 1).cast("string")
    extra = (F.when(F.col("s_suppkey") == 1, F.lit(" {{val:missing.csv[1:1]}}"))
              .when(F.col("s_suppkey") == 2, F.lit(" {{val:region.csv[9:9]}}"))
              .when(F.col("s_suppkey") == 3, F.lit(" {{pic:map.png}} {{foo:bar}} {{val:region.csv[x]}}"))
              .otherwise(F.lit("")))
    text = F.concat(F.lit("Supplier "), F.col("s_name"), F.lit(" lies in {{val:region.csv["), r1,
                    F.lit(":2]}} (#{{val:region.csv["), r1, F.lit(":1]}})"), extra)
    key = F.col("s_suppkey").cast("long")
    texts = s.select(F.lit("suppliers").alias("template"), key.alias("item_no"),
                     F.lit("text").alias("kind"), F.lit(0).cast("long").alias("row_no"),
                     F.lit(0).cast("long").alias("col_no"), text.alias("text"))
    c0 = s.select(F.lit("suppliers").alias("template"), F.lit(0).cast("long").alias("item_no"),
                  F.lit("cell").alias("kind"), key.alias("row_no"),
                  F.lit(0).cast("long").alias("col_no"),
                  F.when(F.col("s_suppkey") == 1, F.lit("{{col:region.csv[2]}}  "))
                   .otherwise(F.col("s_name")).alias("text"))
    c1 = s.select(F.lit("suppliers").alias("template"), F.lit(0).cast("long").alias("item_no"),
                  F.lit("cell").alias("kind"), key.alias("row_no"),
                  F.lit(1).cast("long").alias("col_no"),
                  F.when(F.col("s_suppkey") == 1, F.lit("{{col:region.csv[1]}}"))
                   .otherwise(F.lit("")).alias("text"))
    return texts.unionByName(c0).unionByName(c1)


def cells(spark, sf):
    return RP.frame_cells(table(spark, sf, "region"), "region.csv", ["r_regionkey"])


_ITEMS_SQL = """
WITH items AS (
  SELECT 'suppliers' AS template, CAST(s_suppkey AS BIGINT) AS item_no, 'text' AS kind, 0::BIGINT AS row_no,
    0::BIGINT AS col_no,
    'Supplier ' || s_name || ' lies in {{val:region.csv[' || CAST(s_nationkey % 5 + 1 AS VARCHAR) || ':2]}} (#{{val:region.csv['
      || CAST(s_nationkey % 5 + 1 AS VARCHAR) || ':1]}})' ||
    CASE WHEN s_suppkey = 1 THEN ' {{val:missing.csv[1:1]}}' WHEN s_suppkey = 2 THEN ' {{val:region.csv[9:9]}}'
         WHEN s_suppkey = 3 THEN ' {{pic:map.png}} {{foo:bar}} {{val:region.csv[x]}}' ELSE '' END AS text
  FROM supplier
  UNION ALL SELECT 'suppliers', 0, 'cell', CAST(s_suppkey AS BIGINT), 0,
    CASE WHEN s_suppkey = 1 THEN '{{col:region.csv[2]}}  ' ELSE s_name END FROM supplier
  UNION ALL SELECT 'suppliers', 0, 'cell', CAST(s_suppkey AS BIGINT), 1,
    CASE WHEN s_suppkey = 1 THEN '{{col:region.csv[1]}}' ELSE '' END FROM supplier),
cells AS (
  SELECT 'region.csv' AS file, 0::BIGINT AS row_no, 1::BIGINT AS col_no, 'r_regionkey' AS cell
  UNION ALL SELECT 'region.csv', 0, 2, 'r_name'
  UNION ALL SELECT 'region.csv', row_number() OVER (ORDER BY r_regionkey), 1, CAST(r_regionkey AS VARCHAR) FROM region
  UNION ALL SELECT 'region.csv', row_number() OVER (ORDER BY r_regionkey), 2, r_name FROM region),
found AS (
  SELECT template, item_no, kind, row_no, col_no,
    CASE WHEN kind = 'cell' THEN CASE WHEN regexp_full_match(regexp_replace(text, '\\s+$', ''), '\\{\\{([^:]+):(.+?)\\}\\}')
                                     THEN [regexp_replace(text, '\\s+$', '')] ELSE []::VARCHAR[] END
         ELSE regexp_extract_all(text, '\\{\\{([^:]+):(.+?)\\}\\}', 0) END AS pats
  FROM items),
ph AS (
  SELECT template, item_no, kind, row_no, col_no, CAST(generate_subscripts(pats, 1) - 1 AS INTEGER) AS ph_no,
         unnest(pats) AS pat FROM found),
parsed AS (
  SELECT *, regexp_extract(pat, '\\{\\{([^:]+):(.+?)\\}\\}', 1) AS tag, regexp_extract(pat, '\\{\\{([^:]+):(.+?)\\}\\}', 2) AS data
  FROM ph),
placeholders AS (
  SELECT template, item_no, kind, row_no, col_no, ph_no, pat, tag,
    CASE WHEN tag = 'pic' THEN data
         WHEN tag = 'col' THEN nullif(regexp_extract(data, '^([^\\[\\]]+)\\[(\\d+)\\]$', 1), '')
         WHEN tag = 'val' THEN nullif(regexp_extract(data, '^([^\\[\\]]+)\\[(\\d+):(\\d+)\\]$', 1), '') END AS file,
    CASE WHEN tag = 'val' AND regexp_matches(data, '^([^\\[\\]]+)\\[(\\d+):(\\d+)\\]$')
         THEN CAST(regexp_extract(data, '^([^\\[\\]]+)\\[(\\d+):(\\d+)\\]$', 2) AS BIGINT) END AS ref_row,
    CASE WHEN tag = 'col' AND regexp_matches(data, '^([^\\[\\]]+)\\[(\\d+)\\]$')
         THEN CAST(regexp_extract(data, '^([^\\[\\]]+)\\[(\\d+)\\]$', 2) AS BIGINT)
         WHEN tag = 'val' AND regexp_matches(data, '^([^\\[\\]]+)\\[(\\d+):(\\d+)\\]$')
         THEN CAST(regexp_extract(data, '^([^\\[\\]]+)\\[(\\d+):(\\d+)\\]$', 3) AS BIGINT) END AS ref_col,
    CASE WHEN tag NOT IN ('pic', 'col', 'val') THEN 'error: unknown tag'
         WHEN tag = 'col' AND NOT regexp_matches(data, '^([^\\[\\]]+)\\[(\\d+)\\]$') THEN 'error: bad col spec'
         WHEN tag = 'val' AND NOT regexp_matches(data, '^([^\\[\\]]+)\\[(\\d+):(\\d+)\\]$') THEN 'error: bad val spec'
         ELSE 'ok' END AS status
  FROM parsed),
vals AS (
  SELECT p.*, c.cell, (SELECT count(*) FROM cells c2 WHERE c2.file = p.file) > 0 AS has_file
  FROM placeholders p LEFT JOIN cells c ON c.file = p.file AND c.row_no = p.ref_row AND c.col_no = p.ref_col
  WHERE p.tag = 'val' AND p.status = 'ok'),
bound AS (
  SELECT i.template, i.item_no, i.kind, i.row_no, i.col_no, i.text,
    list_sort(list(struct_pack(ph_no := v.ph_no, pat := v.pat, cell := v.cell)) FILTER (WHERE v.ph_no IS NOT NULL)) AS reps,
    max(CASE WHEN v.ph_no IS NULL THEN 0 WHEN NOT v.has_file THEN 1 WHEN v.cell IS NULL THEN 2 ELSE 0 END) AS worst
  FROM items i LEFT JOIN vals v USING (template, item_no, kind, row_no, col_no)
  GROUP BY ALL),
bound_text AS (
  SELECT template, item_no, kind, row_no, col_no,
    list_reduce(list_prepend(struct_pack(ph_no := -1, pat := '', cell := text), coalesce(reps, [])),
      lambda acc, r: struct_pack(ph_no := 0, pat := '', cell := CASE WHEN r.cell IS NOT NULL THEN replace(acc.cell, r.pat, r.cell) ELSE acc.cell END)).cell AS text,
    CASE worst WHEN 2 THEN 'bad_cell' WHEN 1 THEN 'missing_file' ELSE 'ok' END AS status
  FROM bound),
colspec AS (
  SELECT template, item_no, col_no AS t_col, file, ref_col FROM placeholders
  WHERE kind = 'cell' AND tag = 'col' AND status = 'ok'),
colfill AS (
  SELECT i.template, i.item_no, i.row_no, i.col_no, c.cell AS text
  FROM items i JOIN colspec s ON i.template = s.template AND i.item_no = s.item_no AND i.col_no = s.t_col
  JOIN cells c ON c.file = s.file AND c.row_no = i.row_no AND c.col_no = s.ref_col
  WHERE i.kind = 'cell')
"""


@reg("extract_placeholders", _ITEMS_SQL + """
SELECT template, item_no, kind, row_no, col_no, ph_no, pat, tag, file, ref_row, ref_col, status FROM placeholders""")
def q_extract_placeholders(spark, sf):
    return RP.extract_placeholders(items(spark, sf))


@reg("bind_values", _ITEMS_SQL + "SELECT * FROM bound_text")
def q_bind_values(spark, sf):
    return RP.bind_values(items(spark, sf), cells(spark, sf))


@reg("bind_column", _ITEMS_SQL + "SELECT * FROM colfill")
def q_bind_column(spark, sf):
    return RP.bind_column(items(spark, sf), cells(spark, sf))


@reg("fill_report", _ITEMS_SQL + """
SELECT b.template, b.item_no, b.row_no, b.col_no, b.kind, coalesce(c.text, b.text) AS text, b.status
FROM bound_text b LEFT JOIN colfill c USING (template, item_no, row_no, col_no)""")
def q_fill_report(spark, sf):
    return jobs.fill_report(items(spark, sf), cells(spark, sf))


# Three levels of groups, an empty group at two places and a shape whose group is missing, per supplier.
_SHAPES = [
    (1, None, 2, "group", 0, 0, None), (2, 1, 1, "group", 0, 0, None), (3, 2, 1, "group", 0, 0, None),
    (4, 3, 1, "text", 0, 0, "deep {{val:a.csv[1:1]}}"), (5, 3, 0, "text", 0, 0, "{{pic:x.png}}"),
    (6, 1, 0, "group", 0, 0, None), (7, 1, 2, "cell", 0, 0, "{{col:d.csv[1]}}  "), (7, 1, 2, "cell", 0, 1, "{{col:d.csv[2]}}"),
    (8, None, 1, "text", 0, 0, "first {{val:b.csv[1:2]}} and {{val:b.csv[2:2]}}"),
    (9, 99, 0, "text", 0, 0, "{{pic:lost.png}}"), (10, None, 3, "group", 0, 0, None)]


@reg("nested_placeholders", """
SELECT s_name AS template, CAST(n AS INTEGER) AS n, item_no, pat, file FROM supplier, (VALUES
  (1, '000001', '{{val:b.csv[1:2]}}', 'b.csv'), (2, '000001', '{{val:b.csv[2:2]}}', 'b.csv'),
  (3, '000002.000001.000001.000000', '{{pic:x.png}}', 'x.png'), (4, '000002.000001.000001.000001', '{{val:a.csv[1:1]}}', 'a.csv'),
  (5, '000002.000002', '{{col:d.csv[1]}}', 'd.csv'), (6, '000002.000002', '{{col:d.csv[2]}}', 'd.csv')) AS t(n, item_no, pat, file)
UNION ALL SELECT s_name, NULL, NULL, '{{pic:lost.png}}', 'lost.png' FROM supplier""")
def q_nested_placeholders(spark, sf):
    shape = F.array(*[F.struct(*[F.lit(v).cast(kind).alias(c) for v, (c, kind) in zip(row, (
        ("shape_no", "long"), ("parent_no", "long"), ("position", "int"), ("kind", "string"), ("row_no", "long"),
        ("col_no", "long"), ("text", "string")))]) for row in _SHAPES])
    shapes = table(spark, sf, "supplier").select(F.col("s_name").alias("template"), F.inline(shape))
    found = RP.extract_placeholders(RP.flatten_shapes(shapes))
    # a template's placeholders, in the order in which a reader meets them
    order = Window.partitionBy("template").orderBy(F.col("item_no").asc_nulls_last(), "row_no", "col_no", "ph_no")
    return found.select("template", F.when(F.col("item_no").isNotNull(), F.row_number().over(order)).alias("n"),
                        "item_no", "pat", "file")
