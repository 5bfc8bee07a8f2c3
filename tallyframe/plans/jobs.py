"""User-level jobs composed from the operators: prepare, export, return data, load, report.

Each job is a short chain of DataFrame steps; the actions are the writes, the ``isEmpty``
gate that decides whether a result is exported at all, and the walk over statements or folders.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Callable, Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.text import directives, strip_directives, strip_ws, substitute
from ..operators import registry as RG
from ..operators import report as RP
from ..operators import template as TP
from ..operators.filters import runnable_sets
from ..operators.frames import default_output_name_py
from ..session import materialise, scratch_dir


# prepare_scripts -----------------------------------------------------------------------
def prepare_scripts(scripts: DataFrame, keys: Sequence[str], substitutions: DataFrame | None = None,
                    library: DataFrame | None = None, loop_params: DataFrame | None = None,
                    loop_order: Sequence[str] = (), temp_files: DataFrame | None = None) -> DataFrame:
    """Scripts → prepared statements.

    1. optional layered substitution (``substitutions``: keys…, pairs array) on the script text;
    2. split on ``;``, format, number the non-empty statements;
    3. directives out (run-time ones stay), markers in;
    4. ``file`` includes resolved against ``library`` (name, body); ``temp`` directives
       checked against ``temp_files`` (name) — the CSVs the caller exposes as views;
    5. statements with a ``loop…`` directive fanned out over the rows of their parameter file
       (a loop whose file is missing, or given no ``loop_params`` at all, keeps its template
       with a warning).

    Output: (keys…, stmt_no, sub_no, row_no, sql, status, runtime) — ``row_no`` is 0 for
    statements that are not loops.
    """
    src = scripts
    if substitutions is not None:
        src = src.join(substitutions, list(keys), "left").withColumn(
            "text", substitute(F.col("text"), F.coalesce(F.col("pairs"), F.array().cast(
                "array<struct<priority:int,pos:int,k:string,v:string>>")))).drop("pairs")
    st = TP.with_directives(TP.formatted_statements(src, list(keys)))
    st = st.withColumns({"loop_file": TP.first_loop()["value"], "loop_key": TP.first_loop()["key"]})
    # statement metadata rides along through the include step (no join back)
    carry = ["loop_file", "loop_key", "runtime", "directives"]
    if library is not None:
        inc = TP.include_files(st, library, list(keys), carry=carry)
    else:
        inc = st.select(*keys, "stmt_no", F.lit(1).alias("sub_no"), "sql", F.lit("ok").alias("status"),
                        *carry)
    if temp_files is not None:
        inc = TP.resolve_temp_tables(inc, temp_files, list(keys))
    # inserted texts come before their statement and are never looped themselves
    n_files = F.size(F.filter("directives", lambda d: d["kind"] == "file"))
    itself = F.col("sub_no") == F.greatest(F.lit(1), n_files) if library is not None else F.lit(True)
    inc = inc.withColumn("__loop", F.col("loop_file").isNotNull() & itself)
    zero = F.lit(0).cast("long")
    out = [*keys, "stmt_no", "sub_no", "row_no", "sql", "status", "runtime"]
    missing = {"row_no": zero, "status": F.lit("warning: loop file missing")}
    if loop_params is None:
        # one pass: the loops differ in nothing but their status
        return inc.withColumns({"row_no": zero, "status": F.when(F.col("__loop"), missing["status"]).otherwise(
            F.col("status"))}).select(*out)
    plain = inc.filter(~F.col("__loop")).withColumn("row_no", zero)
    loops = inc.filter("__loop")
    rows = TP.param_rows(loop_params, "file", list(loop_order))
    fanned = TP.param_fanout(loops, rows, loop_key="loop_key")
    # a loop whose parameter file is missing keeps its template statement, with a warning
    known = loop_params.select(F.col("file").alias("loop_file")).distinct()
    orphans = loops.join(known, "loop_file", "left_anti").withColumns(missing)
    return plain.select(*out).unionByName(fanned.select(*out)).unionByName(orphans.select(*out))


# prepare_runs ----------------------------------------------------------------------------
def prepare_runs(pairs: DataFrame, systems: DataFrame, filesets: DataFrame, files: DataFrame,
                 scripts: DataFrame, overrides: DataFrame, params: DataFrame,
                 layers: DataFrame, run_unknown: bool = False, **options) -> DataFrame:
    """The whole prepare chain, from registries to prepared statements.

    Runnable sets and their eligible files (F6, J2) → each file's text, overlaid by overrides
    (J5) → the file's own parameters (J3) → the substitutions of each run in the order of the
    layers (W4, ``registry.LAYERS``) → substituted and prepared statements (T1, ``prepare_scripts``
    with ``options``), keyed by (system, fileset, file).

    ``files``: flat file table of J2; ``scripts``, ``overrides``: (folder, name, body) with the
    fileset as folder; ``params``: (path, pos, params map) of J3, the layer ``file`` in the order of the
    map; ``layers``: (layer, system, fileset, pos, key, value), where a null system or fileset stands
    for all of them.  With ``run_unknown`` a pair whose fileset is not in the master list runs all
    scripts of its folder.  An eligible file without a text comes back as one row (statement 0) with
    the status ``error: no text``.
    """
    keys = ["system", "fileset", "file"]
    runs = RG.eligible_files(pairs, systems, filesets, files=files).select(
        "system", "fileset", RG.basename("gitfile").alias("file"))
    if run_unknown:
        strays = materialise(RG.unknown_filesets(runnable_sets(
            pairs, systems.select("system", "active"), filesets.select("fileset", "active"), run_unknown=True),
            filesets).select("system", "fileset").distinct(), "strays")
        own = scripts.join(strays.select(F.col("fileset").alias("folder")).distinct(), "folder", "left_semi")
        runs = runs.unionByName(strays.join(RG.layered_overlay(own, overrides).select(
            F.col("folder").alias("fileset"), F.col("name").alias("file")), "fileset").select(*keys))
    # a text that stands there several times gets its entries as many times
    texts = RG.layered_overlay(scripts, overrides).select(
        F.col("folder").alias("fileset"), F.col("name").alias("file"), F.col("body").alias("text")).withColumn(
        "__times", F.count("text").over(Window.partitionBy("fileset", "file")))
    # read by two steps below
    runs = materialise(runs.distinct().join(texts, ["fileset", "file"], "left").select(*keys, "text", "__times"), "runs")
    there = RG.file_params(runs.filter("text is not null"), params.withColumn(
        "params", RG.entries_of_map("params", "file")), path="file").withColumnRenamed("file_params", "__file")
    # each layer's entries are one list of what they hold for, so that a run brings lists and no rows
    given, lists = RG.rank_layers(layers.select(
        "layer", "system", "fileset", F.col("pos").cast("long").alias("pos"), "key", "value")), ["__file"]
    for by in (["system", "fileset"], ["system"], ["fileset"]):
        some, name = given, "__" + "_".join(by)
        for c in ("system", "fileset"):
            some = some.filter(F.col(c).isNotNull() if c in by else F.col(c).isNull())
        there = there.join(RG.ordered_layers(some, by).withColumnRenamed("pairs", name), by, "left")
        lists.append(name)
    # what holds for all runs is a configuration's list, attached as one value
    common = RG.ordered_layers(given.filter("system is null and fileset is null"), []).select("pairs").scalar()
    there = there.withColumn("__common", common)
    src = there.select(*keys, substitute(F.col("text"), RG.merged_layers([*lists, "__common"], "__times")).alias("text"))
    prepared = prepare_scripts(src, keys, **options)
    kinds = {f.name: f.dataType for f in prepared.schema.fields}
    fixed = {"stmt_no": F.lit(0), "sub_no": F.lit(0), "row_no": F.lit(0), "status": F.lit("error: no text")}
    lost = runs.filter("text is null").select(*keys, *[
        fixed.get(c, F.lit(None)).cast(kinds[c]).alias(c) for c in prepared.columns if c not in keys])
    return prepared.unionByName(lost)


#: Lines of a job's log that the driver holds before they are written.
LOG_BATCH = 1000


class _Log:
    """A job's log as a written table, appended to in batches."""

    def __init__(self, spark: SparkSession, schema: str):
        self.spark, self.schema, self.path, self.lines = spark, schema, scratch_dir(spark, "log"), []
        self.flush()

    def add(self, line: tuple) -> None:
        self.lines.append(line)
        if len(self.lines) >= LOG_BATCH:
            self.flush()

    def flush(self) -> None:
        self.spark.createDataFrame(self.lines, self.schema).coalesce(1).write.mode("append").parquet(self.path)
        self.lines = []

    def read(self) -> DataFrame:
        if self.lines:
            self.flush()
        return self.spark.read.schema(self.schema).parquet(self.path)


# export_results ------------------------------------------------------------------------
def execution_parts(prepared: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Prepared texts split into the statements that run: ``(keys…, stmt_no, sub_no, row_no, part,
    runtime, sql)``.  An included file may hold several; parts that are empty but for directives
    and comments are left out."""
    text = strip_directives(F.col("raw"))
    bare = strip_ws(F.regexp_replace(text, r"(?s)/\*.*?\*/", ""))
    return prepared.select(*keys, "stmt_no", "sub_no", "row_no", F.posexplode(F.split("sql", ";")).alias("part", "raw")) \
        .filter(bare != "").select(*keys, "stmt_no", "sub_no", "row_no", "part",
                                   directives(F.col("raw")).alias("runtime"), strip_ws(text).alias("sql"))


def export_results(spark: SparkSession, prepared: DataFrame, out_dir: str,
                   keys: Sequence[str] = ("system", "fileset", "file"),
                   run: Callable[[SparkSession, str], DataFrame] | None = None,
                   on_result: Callable[[str, DataFrame], None] | None = None,
                   manifest: str | None = None) -> DataFrame:
    """Run every prepared statement with Spark SQL and export the non-empty results.

    Statements run in execution order and are streamed to the driver one by one; each
    statement's *result* stays a distributed DataFrame written by the executors.  Results are
    named by their ``save`` directive or by their number in execution order, a repeated name
    gets a counter.  A failing statement is logged and the run goes on.  ``manifest`` writes
    the load manifest of the exported results there.
    Every statement runs once: its rows are counted while they are written, and ``on_result`` gets the
    written result.  Returns the log: keys, ``stmt_no`` (execution order), output, written, load, call,
    status; it is written LOG_BATCH lines at a time, so the driver holds no more of it.
    """
    from ..sources.sinks import exported, manifest_write, result_export
    from ..sources.sql import sql_query

    keys = list(keys)
    run = run or sql_query
    schema = ", ".join(f"{k} string" for k in keys) + (
        ", stmt_no int, output string, written boolean, load string, call string, status string")
    log, used, numbers = _Log(spark, schema), Counter(), Counter()
    parts = execution_parts(prepared, keys).orderBy(*keys, "stmt_no", "sub_no", "row_no", "part")
    current = None
    for r in parts.toLocalIterator():
        own = tuple(r[k] for k in keys)
        if own != current:  # statements come script by script
            current, numbers = own, Counter()
        numbers[own] += 1
        rt = r["runtime"] or {}
        name = rt.get("save") or default_output_name_py(*own[:3], numbers[own])
        written, status = False, "ok"
        try:
            df = run(spark, r["sql"])
            target = name[:-4] + ".%03d" % used[name] + name[-4:] if used[name] else name
            written = result_export(df, out_dir, target)
            if written:
                used[name] += 1
                name = target
                if on_result is not None:
                    on_result(name, exported(spark, f"{out_dir.rstrip('/')}/{name}", df.schema))
        except Exception as exc:  # noqa: BLE001 - logged per statement, the run continues
            status = f"failed: {type(exc).__name__}: {str(exc)[:500]}"
        log.add((*map(str, own), numbers[own], name, written, rt.get("load", ""), rt.get("call", ""), status))
    done = log.read()
    if manifest is not None:
        manifest_write(done.select(F.col("output").alias("file"), F.col("load").alias("table"), "call", "written"), manifest)
    return done


# fill_report ---------------------------------------------------------------------------
def fill_report(items: DataFrame, cells: DataFrame) -> DataFrame:
    """Bind every ``val`` and ``col`` placeholder of a template table.

    Texts get their values (J6); table columns are filled top-down (J7); cells not
    touched by a column placeholder keep their text.
    """
    vals = RP.bind_values(items, cells)
    cols = RP.bind_column(items, cells).select(
        "template", "item_no", "row_no", "col_no", F.col("text").alias("__col_text"))
    keys = ["template", "item_no", "row_no", "col_no"]
    out = vals.join(cols, keys, "left")
    return out.select(*keys, "kind", F.coalesce("__col_text", "text").alias("text"), "status")


# Manifest of directives ---------------------------------------------------------------------
def statement_entries(prepared: DataFrame, keys: Sequence[str] = ("system", "fileset", "file"),
                      pairs: DataFrame | None = None) -> DataFrame:
    """``(file, table, call)`` of every statement that is to be loaded: its ``save``, ``load`` and
    ``call`` directives, a missing one empty; before them the keys, each after ``of_``.

    ``pairs`` (keys..., pairs: ordered substitutions as ``resolve_layers`` and ``ordered_layers`` give them)
    are filled into all three, in their order.
    """
    keys = list(keys)
    parts = execution_parts(prepared, keys)
    named = [F.coalesce(F.col("runtime")[k], F.lit("")).alias(c) for k, c in (("save", "file"), ("load", "table"), ("call", "call"))]
    own = [f"of_{k}" for k in keys]
    entries = parts.select(*[F.col(k).alias(o) for k, o in zip(keys, own)], *named).filter("`table` <> '' or call <> ''")
    if pairs is None:
        return entries
    none = F.array().cast("array<struct<priority:int,pos:int,k:string,v:string>>")
    given = pairs.select(*[F.col(k).alias(o) for k, o in zip(keys, own)], "pairs")
    filled = entries.join(given, own, "left").withColumn("pairs", F.coalesce("pairs", none))
    return filled.select(*own, *[substitute(F.col(c), F.col("pairs")).alias(c) for c in ("file", "table", "call")])


# return_data -----------------------------------------------------------------------------
def return_data(spark: SparkSession, in_dir: str, out_dir: str,
                on_result: Callable[[str, DataFrame], None] | None = None,
                handlers: Mapping[str, Callable[[DataFrame], DataFrame]] | None = None,
                manifest: str | None = None, entries: DataFrame | None = None) -> DataFrame:
    """Returned result files → separator sniffed per file → stripped comma CSV per folder and separator.

    The sniffing is one distributed aggregation over all files.  Files of one folder with one
    separator are one distributed read and write, so the driver walks folders, not files.
    ``handlers`` run on non-empty results by folder name, ``on_result`` on every one;
    ``manifest`` writes the load manifest: table and call of a result are those of the entry (file, table,
    call) of ``entries`` (``statement_entries``) that is called like it, without one the folder's name and
    nothing.  Each result is read and written once, and counted meanwhile.  Returns (folder, delimiter,
    n_files, output, written).
    """
    from ..sources.files import delimited_rows, delimiter_sniff
    from ..sources.sinks import exported, manifest_write
    from .observed import counted

    sniffed = delimiter_sniff(spark, in_dir).withColumn("folder", F.regexp_replace("path", "/[^/]*$", ""))
    groups = sniffed.groupBy("folder", "delimiter").agg(F.collect_list("path").alias("paths")).orderBy("folder", "delimiter")
    log, used = [], Counter()
    for r in groups.toLocalIterator():
        name = r["folder"].rstrip("/").split("/")[-1]
        used[name] += 1
        out = f"{out_dir.rstrip('/')}/{name}" + (f".{used[name] - 1:03d}" if used[name] > 1 else "") + ".csv"
        df = delimited_rows(spark, r["paths"], sep=r["delimiter"])
        rows, count = counted(df)
        rows.write.mode("overwrite").option("header", True).option("quoteAll", True).option("escape", '"').csv(out)
        n = count()
        if n:
            written = exported(spark, out, df.schema)
            if on_result is not None:
                on_result(out, written)
            if handlers and name in handlers:
                handlers[name](written)
        log.append((r["folder"], name, r["delimiter"], len(r["paths"]), out, n > 0))
    found = spark.createDataFrame(log, "folder string, name string, delimiter string, n_files int, output string, written boolean")
    if manifest is not None:
        listed = found.select(F.element_at(F.split("output", "/"), -1).alias("file"), "name", "written")
        none = spark.createDataFrame([], "file string, `table` string, call string")
        named = (none if entries is None else entries.select("file", "table", "call")).groupBy("file").agg(
            F.min(F.struct("table", "call")).alias("entry"))
        manifest_write(listed.join(named, "file", "left").select(
            "file", F.coalesce(F.nullif("entry.table", F.lit("")), "name").alias("table"),
            F.coalesce("entry.call", F.lit("")).alias("call"), "written"), manifest)
    return found.drop("name")


# load_manifest ---------------------------------------------------------------------------
def load_manifest(spark: SparkSession, manifest_path: str, base_dir: str,
                  hooks: Mapping[str, Callable[[SparkSession, str], None]] | None = None,
                  default_schema: str = "", snapshot: bool = False) -> DataFrame:
    """Read a load manifest and load every entry (S9 → S14); returns the status rows."""
    from ..sources.files import manifest_read
    from ..sources.sinks import staged_load

    entries = manifest_read(spark, manifest_path, default_schema=default_schema)
    return staged_load(spark, entries, base_dir, hooks=hooks, snapshot=snapshot)
