"""Report binding: placeholders in template texts and table cells, bound to CSV cells
(T7, J6, J7).

Templates are rows ``(template, item_no, kind, row_no, col_no, text)`` where ``kind`` is
``text`` for a text box and ``cell`` for a table cell.  Data files are long cell grids
``(file, row_no, col_no, cell)`` with row 0 the header and columns numbered from 1.
Binding is one equi-join on (file, row, column); nothing is cached or collected.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import PLACEHOLDER_PATTERN
from ..session import materialise
from .ranking import grouped_row_number

# Known tags and the two specification forms.
TAGS = ("pic", "col", "val")
COL_SPEC = r"^([^\[\]]+)\[(\d+)\]$"
VAL_SPEC = r"^([^\[\]]+)\[(\d+):(\d+)\]$"


def frame_cells(df: DataFrame, file: str, order: Sequence[str]) -> DataFrame:
    """A DataFrame as the cell grid of its CSV export: header row 0, data rows 1.. in
    ``order``, columns from 1, every cell as text."""
    cols = df.columns
    ranked = grouped_row_number(df, [], list(order), out="__rn")
    body = ranked.select(F.lit(file).alias("file"), F.col("__rn").alias("row_no"), F.posexplode(
        F.array(*[F.col(f"`{c}`").cast("string") for c in cols])).alias("__p", "cell"))
    header = df.sparkSession.range(1).select(
        F.lit(file).alias("file"), F.lit(0).cast("long").alias("row_no"),
        F.posexplode(F.array(*[F.lit(c) for c in cols])).alias("__p", "cell"))
    return body.unionByName(header).select("file", "row_no", (F.col("__p") + 1).alias("col_no"), "cell")


# T7 ------------------------------------------------------------------------------------
def extract_placeholders(items: DataFrame, carry: Sequence[str] = (), outer: bool = False) -> DataFrame:
    """Every ``{{tag:data}}``: searched in texts, whole-cell (right-trimmed) in table cells.

    Output: item keys, ``carry`` columns, ``ph_no``, ``pat``, ``tag``, ``file``, ``ref_row``,
    ``ref_col`` and ``status`` (``ok`` or an error; errors do not stop the others).  With
    ``outer`` an item without placeholders keeps one row whose ``pat`` and ``tag`` are null.
    """
    keys = ["template", "item_no", "kind", "row_no", "col_no"]
    rt = F.regexp_replace("text", r"\s+$", "")
    found = F.when(F.col("kind") == "cell",
                   F.when(rt.rlike("^" + PLACEHOLDER_PATTERN + "$"), F.array(rt))
                    .otherwise(F.array().cast("array<string>"))) \
             .otherwise(F.regexp_extract_all("text", F.lit(PLACEHOLDER_PATTERN), 0))
    carry = list(carry)
    explode = F.posexplode_outer if outer else F.posexplode
    ph = items.select(*keys, *carry, explode(found).alias("ph_no", "pat"))
    tag = F.regexp_extract("pat", PLACEHOLDER_PATTERN, 1)
    data = F.regexp_extract("pat", PLACEHOLDER_PATTERN, 2)
    ph = ph.withColumns({"tag": tag, "data": data})
    col_ok = F.col("data").rlike(COL_SPEC)
    val_ok = F.col("data").rlike(VAL_SPEC)
    return ph.select(
        *keys, *carry, "ph_no", "pat", "tag",
        F.when(F.col("tag") == "pic", F.col("data"))
         .when(F.col("tag") == "col", F.nullif(F.regexp_extract("data", COL_SPEC, 1), F.lit("")))
         .when(F.col("tag") == "val", F.nullif(F.regexp_extract("data", VAL_SPEC, 1), F.lit("")))
         .alias("file"),
        F.when((F.col("tag") == "val") & val_ok,
               F.regexp_extract("data", VAL_SPEC, 2).cast("long")).alias("ref_row"),
        F.when((F.col("tag") == "col") & col_ok, F.regexp_extract("data", COL_SPEC, 2).cast("long"))
         .when((F.col("tag") == "val") & val_ok, F.regexp_extract("data", VAL_SPEC, 3).cast("long"))
         .alias("ref_col"),
        F.when(~F.col("tag").isin(*TAGS), F.lit("error: unknown tag"))
         .when((F.col("tag") == "col") & ~col_ok, F.lit("error: bad col spec"))
         .when((F.col("tag") == "val") & ~val_ok, F.lit("error: bad val spec"))
         .otherwise(F.lit("ok")).alias("status"))


#: Digits of a position in a path, so that paths sort as their positions do.
_POSITION_DIGITS = 6


def flatten_shapes(shapes: DataFrame) -> DataFrame:
    """Shapes in groups in groups → template items, each with its path: ``template, item_no, kind, row_no,
    col_no, text, status``.

    ``shapes``: (template, shape_no, parent_no, position, kind, row_no, col_no, text), where kind is
    ``group``, ``text`` or ``cell`` (a table has one row per cell) and a shape at the top has no parent.  ``item_no``
    is the path of positions from the top, as text that sorts in the order in which a reader meets
    the shapes: by position, a group's members where the group stands.  Empty groups give no item.  An
    item whose chain of groups does not lead to the top has no path and the status ``orphan``.

    A recursive query walks the groups alone; items are joined to their group once.
    """
    spark = shapes.sparkSession
    place = F.lpad(F.col("position").cast("string"), _POSITION_DIGITS, "0")
    placed = shapes.withColumn("place", place)
    groups = placed.filter("kind = 'group'").select("template", "shape_no", "parent_no", "place")
    limit = spark.conf.get("spark.sql.cteRecursionRowLimit")
    spark.conf.set("spark.sql.cteRecursionRowLimit", "-1")  # as many groups as there are
    try:
        paths = materialise(spark.sql("""
            WITH RECURSIVE walked(template, shape_no, path) AS (
              SELECT template, shape_no, place FROM {groups} WHERE parent_no IS NULL
              UNION ALL
              SELECT g.template, g.shape_no, concat(w.path, '.', g.place)
              FROM walked w JOIN {groups} g ON g.template = w.template AND g.parent_no = w.shape_no)
            SELECT template, shape_no AS parent_no, path FROM walked""", groups=groups), "paths")
    finally:
        spark.conf.set("spark.sql.cteRecursionRowLimit", limit)
    items = placed.filter("kind <> 'group'").join(paths, ["template", "parent_no"], "left")
    path = F.when(F.col("parent_no").isNull(), F.col("place")).otherwise(F.concat_ws(".", "path", "place"))
    top = F.col("parent_no").isNull() | F.col("path").isNotNull()
    return items.select("template", F.when(top, path).alias("item_no"), "kind", "row_no", "col_no", "text",
                        F.when(top, "ok").otherwise("orphan").alias("status"))


# J6 ------------------------------------------------------------------------------------
def bind_values(items: DataFrame, cells: DataFrame) -> DataFrame:
    """Replace each ``{{val:file[row:col]}}`` in its text by that cell.

    Missing file: text left as is, status ``missing_file``.  Cell out of range: status
    ``bad_cell`` (the text keeps that placeholder).  Output: one row per item with the
    bound ``text`` and the worst ``status``.
    """
    # every item keeps one row (outer) and its text rides along, so the per-item result
    # needs no join back to ``items``
    ph = extract_placeholders(items, carry=["text"], outer=True).withColumn(
        "__val", F.coalesce((F.col("tag") == "val") & (F.col("status") == "ok"), F.lit(False)))
    files = cells.select(F.col("file").alias("__f")).distinct().withColumn("__has", F.lit(True))
    c = cells.select(F.col("file").alias("__cf"), F.col("row_no").alias("__r"),
                     F.col("col_no").alias("__c"), "cell")
    j = (ph.join(files, F.col("__val") & (ph.file == files.__f), "left")
           .join(c, F.col("__val") & (ph.file == c.__cf) & (ph.ref_row == c.__r) & (ph.ref_col == c.__c),
                 "left"))
    st = (F.when(F.col("__has").isNull(), F.lit("missing_file"))
           .when(F.col("cell").isNull(), F.lit("bad_cell")).otherwise(F.lit("ok")))
    keys = ["template", "item_no", "kind", "row_no", "col_no"]
    out = j.groupBy(*keys).agg(
        F.first("text").alias("text"),
        F.array_sort(F.collect_list(F.when(F.col("__val"), F.struct("ph_no", "pat", "cell")))).alias("__reps"),
        F.max(F.when(F.col("__val"), F.when(st == "bad_cell", 2).when(st == "missing_file", 1)
                     .otherwise(0))).alias("__worst"))
    bound = F.aggregate(F.coalesce("__reps", F.array().cast(
        "array<struct<ph_no:int,pat:string,cell:string>>")), F.col("text"),
        lambda acc, r: F.when(r["cell"].isNotNull(), F.replace(acc, r["pat"], r["cell"])).otherwise(acc))
    status = (F.when(F.col("__worst") == 2, "bad_cell").when(F.col("__worst") == 1, "missing_file")
               .otherwise("ok"))
    return out.select(*keys, bound.alias("text"), status.alias("status"))


# J7 ------------------------------------------------------------------------------------
def bind_column(items: DataFrame, cells: DataFrame) -> DataFrame:
    """Fill a table column top-down from ``{{col:file[n]}}`` (header included).

    The placeholder sits in some cell of the target column; rows ``0..`` of that column
    receive rows ``0..`` of column ``n``, cut at the shorter of table and file.
    Output: (template, item_no, row_no, col_no, text) for every filled cell.
    """
    ph = extract_placeholders(items.filter(F.col("kind") == "cell")).filter(
        (F.col("tag") == "col") & (F.col("status") == "ok"))
    target = items.filter(F.col("kind") == "cell").select(
        "template", "item_no", F.col("row_no").alias("t_row"), F.col("col_no").alias("t_col"))
    spec = ph.select("template", "item_no", F.col("col_no").alias("t_col"), "file", "ref_col")
    rows = target.join(spec, ["template", "item_no", "t_col"])
    c = cells.select(F.col("file").alias("__cf"), F.col("row_no").alias("__r"),
                     F.col("col_no").alias("__c"), "cell")
    j = rows.join(c, (rows.file == c.__cf) & (rows.t_row == c.__r) & (rows.ref_col == c.__c), "inner")
    return j.select("template", "item_no", F.col("t_row").alias("row_no"),
                    F.col("t_col").alias("col_no"), F.col("cell").alias("text"))
