"""Script preparation as data: statements, directives, includes and parameter fan-out
(T2, T3-T6, W5, W6, J4).

A script is a row ``(keys..., text)``; a prepared statement is a row.  Splitting and
numbering happen inside each row's array (no window), includes and loops are equi-joins
on the referenced file name.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import (EXACT_KINDS, directive_kind, directive_matches, format_statement,
                              strip_ws, substitute)
from .ranking import grouped_row_number

# The texts that replace a directive's marker.
FILE_BEGIN = "/* BEGIN file insert: %s */ \n"
FILE_END = "END file insert: %s"
TEMP_NOTE = "above volatile table create script for %s"
LOOP_NOTE = " csv row %d out of %d "


# T2 + W6 (execute numbering: every part counts) -----------------------------------------
def split_statements(scripts: DataFrame, keys: Sequence[str], text: str = "text") -> DataFrame:
    """One row per ``;``-separated part, numbered from 1 in script order (empty parts too)."""
    return scripts.select(*keys, F.posexplode(F.split(F.col(text), ";")).alias("pos", "raw")) \
        .select(*keys, (F.col("pos") + 1).alias("stmt_no"), "raw")


# T3 + W6 (prepare numbering: only non-empty statements count) ---------------------------
def formatted_statements(scripts: DataFrame, keys: Sequence[str], text: str = "text") -> DataFrame:
    """Formatted, non-empty statements numbered 1.. per script (numbered inside the row)."""
    parts = F.filter(F.transform(F.split(F.col(text), ";"), lambda p: format_statement(p)),
                     lambda s: s != "")
    return scripts.select(*keys, F.posexplode(parts).alias("pos", "sql")).select(
        *keys, (F.col("pos") + 1).alias("stmt_no"), "sql")


# T4/T5/W5 --------------------------------------------------------------------------------
def with_directives(stmts: DataFrame, sql: str = "sql",
                    keep: Sequence[str] = EXACT_KINDS) -> DataFrame:
    """Pull ``/*{{key:value}}*/`` directives out of each statement.

    Adds ``directives`` (array of key/value/kind; repeated keys keep the last value) and
    rewrites the text: directives in ``keep`` stay verbatim (they act at run time), the
    others become ``/* {{replaceMe:key}} */`` markers for the expansion steps.
    """
    stmts = stmts.withColumn("__dm", directive_matches(F.col(sql)))  # parsed once per row
    m = F.col("__dm")
    active = F.filter(m, lambda d: ~d["key"].isin(list(keep)))
    # last value per key wins: keep an entry only if no later entry has the same key
    last = F.filter(
        F.transform(active, lambda d, i: F.struct(d["key"].alias("key"), d["value"].alias("value"),
                                                  d["find"].alias("find"), i.alias("i"))),
        lambda d: ~F.exists(F.slice(F.transform(active, lambda x: x["key"]), d["i"] + 2, F.size(active)),
                            lambda k: k == d["key"]))
    rewritten = F.aggregate(active, F.col(sql), lambda acc, d: F.replace(
        acc, d["find"], F.concat(F.lit("/* {{replaceMe:"), d["key"], F.lit("}} */"))))
    runtime = F.filter(m, lambda d: d["key"].isin(list(keep)))
    return stmts.withColumns({
        "directives": F.transform(last, lambda d: F.struct(
            d["key"].alias("key"), d["value"].alias("value"), directive_kind(d["key"]).alias("kind"))),
        "runtime": F.map_from_entries(F.transform(
            F.filter(F.transform(runtime, lambda d, i: F.struct(d["key"].alias("k"), d["value"].alias("v"), i.alias("i"))),
                     lambda d: ~F.exists(F.slice(F.transform(runtime, lambda x: x["key"]), d["i"] + 2, F.size(runtime)),
                                         lambda k: k == d["k"])),
            lambda d: F.struct(d["k"], d["v"]))),
        sql: rewritten,
    }).drop("__dm")


def directive_rows(stmts: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Long form: one row per (statement, directive)."""
    return stmts.select(*keys, F.inline("directives"))


# T6 ------------------------------------------------------------------------------------
def include_files(stmts: DataFrame, library: DataFrame, keys: Sequence[str],
                  carry: Sequence[str] = ()) -> DataFrame:
    """Resolve ``file`` directives: the named text is inserted as its own statement before
    the one that names it, and the marker reads ``END file insert: <name>``.

    Several includes of a statement stand in the order of their directives: ``sub_no`` counts
    them from 0, and the statement itself comes after them (at least 1).
    ``library`` holds ``(name, body)``.  A missing file leaves a warning status and the
    statement unchanged.  Output rows: ``(keys..., stmt_no, sub_no, sql, status, carry...)``;
    the ``carry`` columns of a statement go onto its inserts too, so callers need no join
    to bring statement metadata back.
    """
    carry = list(carry)
    d = stmts.select(*keys, "stmt_no", "sql", *carry, F.posexplode(F.filter(
        "directives", lambda x: x["kind"] == "file")).alias("place", "d"))
    lib = library.select(F.col("name").alias("__name"), F.col("body").alias("__body"))
    j = d.join(lib, F.col("d.value") == F.col("__name"), "left")
    files = j
    inserts = files.filter(F.col("__body").isNotNull()).select(
        *keys, "stmt_no", F.col("place").alias("sub_no"),
        F.concat(F.format_string(FILE_BEGIN, F.col("d.value")), F.col("__body")).alias("sql"),
        F.lit("ok").alias("status"), *carry)
    # apply every found include's marker rewrite to its statement
    marks = files.groupBy(*keys, "stmt_no").agg(
        F.collect_list(F.struct(F.col("d.key").alias("key"), F.col("d.value").alias("value"),
                                F.col("__body").isNotNull().alias("found"))).alias("__m"))
    base = stmts.select(*keys, "stmt_no", "sql", *carry).join(marks, [*keys, "stmt_no"], "left")
    marks_or_none = F.coalesce(F.col("__m"), F.array().cast(
        "array<struct<key:string,value:string,found:boolean>>"))
    fixed = F.aggregate(marks_or_none, F.col("sql"),
        lambda acc, m: F.when(m["found"], F.replace(
            acc, F.concat(F.lit("{{replaceMe:"), m["key"], F.lit("}}")),
            F.format_string(FILE_END, m["value"]))).otherwise(acc))
    status = F.when(F.exists(marks_or_none, lambda m: ~m["found"]),
                    F.lit("warning: file missing")).otherwise(F.lit("ok"))
    main = base.select(*keys, "stmt_no", F.greatest(F.lit(1), F.size(marks_or_none)).alias("sub_no"), fixed.alias("sql"),
                       status.alias("status"), *carry)
    return inserts.unionByName(main)


def resolve_temp_tables(stmts: DataFrame, available: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``temp`` directives name a CSV exposed as a session view (``csv_temp_view``).

    Statements whose CSV is among ``available`` (a ``name`` column) get the marker
    ``above volatile table create script for <name>``; a missing CSV is an error status
    (the statement is kept so the error is reported, not silently dropped).
    ``stmts`` needs ``directives``, ``sql`` and ``status``.
    """
    t = stmts.select(*keys, "stmt_no", "sub_no", F.explode(F.filter(
        "directives", lambda d: d["kind"] == "temp")).alias("d"))
    found = t.join(available.select(F.col("name").alias("__n")), F.col("d.value") == F.col("__n"), "left")
    marks = found.groupBy(*keys, "stmt_no", "sub_no").agg(F.collect_list(F.struct(
        F.col("d.key").alias("key"), F.col("d.value").alias("value"),
        F.col("__n").isNotNull().alias("found"))).alias("__t"))
    j = stmts.join(marks, [*keys, "stmt_no", "sub_no"], "left")
    none = F.array().cast("array<struct<key:string,value:string,found:boolean>>")
    ms = F.coalesce(F.col("__t"), none)
    sql = F.aggregate(ms, F.col("sql"), lambda acc, m: F.when(m["found"], F.replace(
        acc, F.concat(F.lit("{{replaceMe:"), m["key"], F.lit("}}")), F.format_string(TEMP_NOTE, m["value"])))
        .otherwise(acc))
    status = F.when(F.exists(ms, lambda m: ~m["found"]), F.lit("error: temp file missing")).otherwise(F.col("status"))
    return j.withColumns({"sql": sql, "status": status}).drop("__t")


# J4 ------------------------------------------------------------------------------------
def param_rows(params: DataFrame, file: str, order: Sequence[str]) -> DataFrame:
    """Parameter CSV rows → ``(file, row_no, n_rows, pairs)`` with ``pairs`` the row's
    ``{column}`` → stripped cell list in column order."""
    cols = [c for c in params.columns if c != file]
    pairs = F.array(*[F.struct(F.lit(c.strip()).alias("k"),
                               strip_ws(F.col(f"`{c}`").cast("string")).alias("v")) for c in cols])
    ranked = grouped_row_number(params, [file], list(order), out="row_no")
    sizes = params.groupBy(file).agg(F.count(F.lit(1)).alias("n_rows"))
    return ranked.select(F.col(file).alias("file"), "row_no", pairs.alias("pairs")).join(
        sizes.withColumnRenamed(file, "file"), "file")


def first_loop(directives: str = "directives"):
    """The statement's loop directive (struct of key and value) or null.  A statement is looped
    over the file of its first one; its other loops would only repeat an empty text."""
    return F.get(F.filter(directives, lambda d: d["kind"] == "loop"), 0)


def param_fanout(templates: DataFrame, rows: DataFrame, loop_file: str = "loop_file",
                 sql: str = "sql", loop_key: str | None = None) -> DataFrame:
    """One rendered statement per (template, row of the template's loop file).

    An equi-join on the file name; the marker of the loop's directive (its key is in the
    column ``loop_key``, default ``loop``) becomes ``csv row i out of n``.  No eager size probe: AQE broadcasts the template side at
    run time when its materialized size is below the adaptive threshold, and otherwise
    keeps a sort-merge join whose hot file key its skew-join handling splits.
    """
    rows = rows.withColumnRenamed("file", "__loop_file")  # a key of the templates may be called file
    j = templates.join(rows, F.col(loop_file) == F.col("__loop_file"), "inner")
    marker = F.concat(F.lit("{{replaceMe:"), F.col(loop_key) if loop_key else F.lit("loop"), F.lit("}}"))
    text = substitute(F.col(sql), F.col("pairs"))
    text = F.replace(text, marker,
                     F.format_string(LOOP_NOTE, F.col("row_no"), F.col("n_rows")))
    return j.withColumn(sql, text).drop("pairs", "__loop_file")
