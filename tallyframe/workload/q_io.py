"""Sources, sinks, hooks and the IO composites (S1-S14, X1-X3, export_results, return_data,
load_manifest).  Each query writes driver-table data into a fresh folder under the shared
checkpoint location, then runs the operator on what was written."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from ..operators import charts as C
from ..operators import clean as P
from ..operators import registry as RG
from ..operators import template as TP
from ..plans import hooks as H
from ..plans import jobs
from ..session import materialise, scratch_dir
from ..sources import files as S
from ..sources import ledger as L
from ..sources import sinks as K
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


def _csv(df, path, sep=",", single=False):
    w = (df.coalesce(1) if single else df).write.mode("overwrite").option("header", True) \
        .option("escape", '"').option("sep", sep)
    w.csv(path)
    return path


_CUST_SQL = ("CAST(c_custkey AS INTEGER) AS c_custkey, c_name, CAST(c_nationkey AS INTEGER) AS c_nationkey, "
             "round(c_acctbal, 6) AS c_acctbal, c_mktsegment")


@reg("csv_scan", f"SELECT {_CUST_SQL} FROM customer")
def q_csv_scan(spark, sf):
    d = scratch_dir(spark, "csv-scan")
    _csv(table(spark, sf, "customer"), d)
    return r6(S.csv_scan(spark, d))


@reg("csv_cells", """
WITH s AS (SELECT s_suppkey // 1000 AS block, s_suppkey % 2 = 1 AS wide, s_suppkey, s_name, s_nationkey,
                  row_number() OVER (PARTITION BY s_suppkey // 1000, s_suppkey % 2 ORDER BY s_suppkey) AS row_no FROM supplier),
c AS (SELECT block, wide, row_no, 1 AS col_no, CAST(s_suppkey AS VARCHAR) AS cell FROM s
  UNION ALL SELECT block, wide, row_no, 2, s_name || ', "' || s_nationkey || '"' FROM s
  UNION ALL SELECT block, wide, row_no, 3, CAST(s_nationkey AS VARCHAR) FROM s WHERE wide
  UNION ALL SELECT DISTINCT block, wide, 0, 1, 's_suppkey' FROM s
  UNION ALL SELECT DISTINCT block, wide, 0, 2, 's_name' FROM s
  UNION ALL SELECT DISTINCT block, wide, 0, 3, 's_nationkey' FROM s WHERE wide)
SELECT CAST(block AS INTEGER) AS block, wide, CAST(row_no AS BIGINT) AS row_no, CAST(col_no AS INTEGER) AS col_no, cell FROM c""")
def q_csv_cells(spark, sf):
    d = scratch_dir(spark, "csv-cells")
    # a CSV per block of 1000 supplier keys and parity, of two widths, rows in key order; names
    # hold separators and quotes
    s = table(spark, sf, "supplier").select(
        F.floor(F.col("s_suppkey") / 1000).alias("block"), "s_suppkey", F.concat(
            "s_name", F.lit(', "'), "s_nationkey", F.lit('"')).alias("s_name"), "s_nationkey")
    for name, odd, cols in (("narrow", 0, ["s_suppkey", "s_name"]), ("wide", 1, ["s_suppkey", "s_name", "s_nationkey"])):
        (s.filter(F.col("s_suppkey") % 2 == odd).select("block", *cols).repartition("block")
         .sortWithinPartitions("block", "s_suppkey").write.partitionBy("block").option("header", True)
         .option("escape", '"').csv(f"{d}/{name}"))
    cells = S.csv_cells(spark, d, with_path=True)
    return cells.select(F.regexp_extract("path", r"block=(\d+)", 1).cast("int").alias("block"),
                        F.contains("path", F.lit("/wide/")).alias("wide"), "row_no", "col_no", "cell")


_SEPARATORS = ["|", ";", "|~|", ","]


@reg("delimiter_sniff", "SELECT delimiter, count(DISTINCT c_custkey // 1000) AS n_files FROM customer, "
     "(VALUES " + ", ".join(f"('{s}')" for s in _SEPARATORS) + ") s(delimiter) GROUP BY delimiter")
def q_delimiter_sniff(spark, sf):
    d = scratch_dir(spark, "sniff")
    # a file per block of 1000 customers and separator, same names in every folder
    c = table(spark, sf, "customer").withColumn("block", F.floor(F.col("c_custkey") / 1000))
    for i, sep in enumerate(_SEPARATORS):
        c.repartition("block").write.partitionBy("block").option("header", True).option("escape", '"').option(
            "sep", sep).csv(f"{d}/s{i}")
    return S.delimiter_sniff(spark, d).groupBy("delimiter").agg(F.count(F.lit(1)).alias("n_files"))


@reg("delimited_normalise", f"SELECT {_CUST_SQL} FROM customer")
def q_delimited_normalise(spark, sf):
    d = scratch_dir(spark, "normalise")
    c = table(spark, sf, "customer").select(
        F.col("c_custkey").alias(" c_custkey "), F.concat(F.lit("  "), "c_name", F.lit(" ")).alias("c_name"),
        "c_nationkey", "c_acctbal", F.concat(F.lit(" "), "c_mktsegment").alias("c_mktsegment "))
    _csv(c, d + "/in", sep="|~|")
    return r6(S.delimited_normalise(spark, d + "/in", d + "/out", sep="|~|"))


_S5_SQL = """
SELECT n.n_name, c.c_mktsegment, count(*) AS n_orders, {rev} AS revenue,
       CAST(rank() OVER (PARTITION BY n.n_name ORDER BY sum(o.o_totalprice) DESC) AS INTEGER) AS seg_rank
FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey JOIN nation n ON c.c_nationkey = n.n_nationkey
WHERE o.o_totalprice > {p}
GROUP BY n.n_name, c.c_mktsegment"""


@reg("sql_query", _S5_SQL.format(p="1000", rev="round(sum(o.o_totalprice), 6)"))
def q_sql_query(spark, sf):
    from ..sources.sql import sql_query
    for t in ("orders", "customer", "nation"):
        table(spark, sf, t).createOrReplaceTempView(t)
    return r6(sql_query(spark, _S5_SQL.format(p=":min_price", rev="sum(o.o_totalprice)"), {"min_price": 1000}))


@reg("csv_temp_view", """
SELECT CAST(s_suppkey AS BIGINT) AS s_suppkey, s_name, CAST(s_nationkey AS BIGINT) AS s_nationkey FROM supplier""")
def q_csv_temp_view(spark, sf):
    d = scratch_dir(spark, "tempview") + "/supplier_csv.csv"
    _csv(table(spark, sf, "supplier").select("s_suppkey", "s_name", "s_nationkey"), d)
    view = S.csv_temp_view(spark, d)
    return spark.sql(f"SELECT * FROM {view}")


@reg("script_scan", """
SELECT 'n' || CAST(s_nationkey AS VARCHAR) AS system, 'b' || CAST(s_suppkey // 1000 AS VARCHAR) AS fileset,
       string_agg('SELECT ' || CAST(s_suppkey AS VARCHAR), chr(10) ORDER BY s_suppkey) || chr(10) AS text
FROM supplier GROUP BY 1, 2""")
def q_script_scan(spark, sf):
    d = scratch_dir(spark, "scripts")
    # one script per (nation, block of 1000 supplier keys): the number of files grows with
    # supplier while each file stays bounded
    sp = table(spark, sf, "supplier").select(
        F.concat(F.lit("n"), F.col("s_nationkey").cast("string")).alias("system"),
        F.concat(F.lit("b"), F.floor(F.col("s_suppkey") / 1000).cast("string")).alias("fileset"),
        "s_suppkey", F.concat(F.lit("SELECT "), F.col("s_suppkey").cast("string")).alias("value"))
    (sp.repartition("system", "fileset").sortWithinPartitions("system", "fileset", "s_suppkey")
       .drop("s_suppkey").write.partitionBy("system", "fileset").text(d))
    return S.script_scan(spark, d, pattern="*.txt").select("system", "fileset", "text")


#: Files per segment of the drop folder, written in parallel.
DROP_FILES = 4


def _drop_folder(spark, sf, layouts=True):
    d = scratch_dir(spark, "drop")
    c = table(spark, sf, "customer").select(
        "c_custkey", "c_name", "c_mktsegment", F.lower("c_mktsegment").alias("seg"),
        (F.col("c_custkey") % DROP_FILES).alias("part"))
    names = []
    for odd, cols in ((0, ["c_custkey", "c_name", "c_mktsegment"]), (1, ["c_name", "c_custkey"] if layouts else [
            "c_custkey", "c_name", "c_mktsegment"])):
        own = c.filter(F.col("part") % 2 == odd)
        (own.select(*cols, "seg", "part").repartition("seg", "part").write.partitionBy("seg", "part")
         .option("header", True).option("escape", '"').csv(f"{d}/out{odd}"))
        names += [(odd, r["seg"], r["part"]) for r in own.select("seg", "part").distinct().toLocalIterator()]
    # renamed to their delivery names (a handful: segments x DROP_FILES)
    for odd, seg, part in names:
        K.publish_single_file(spark, f"{d}/out{odd}/seg={seg}/part={part}", f"{d}/in/sys1.{seg}.customers{part}.csv")
    return d + "/in"


@reg("drop_folder_scan", """
SELECT CAST(c_custkey AS INTEGER) AS c_custkey, c_name, CASE WHEN c_custkey % 2 = 0 THEN c_mktsegment END AS c_mktsegment,
       'sys1' AS system, lower(c_mktsegment) AS fileset, 'customers' || c_custkey % 4 || '.csv' AS name FROM customer""")
def q_drop_folder_scan(spark, sf):
    # odd files have another header: fewer columns, in another order
    out = S.drop_folder_scan(spark, _drop_folder(spark, sf))
    return out.select("c_custkey", "c_name", "c_mktsegment", "system", "fileset", "name")


def _manifest_entries(spark, sf):
    # one entry per nation that has suppliers: the export log of per-nation result files
    # (the manifest is one document, so its entries stay bounded while the work grows)
    n = table(spark, sf, "nation").join(table(spark, sf, "supplier"),
                                        F.col("n_nationkey") == F.col("s_nationkey"), "left_semi")
    return n.select(
        F.concat(F.lower("n_name"), F.lit(".csv")).alias("file"),
        F.when(F.col("n_regionkey") < 2, F.concat(F.lit("stage."), F.lower("n_name")))
         .when(F.col("n_regionkey") == 2, F.lit(""))
         .otherwise(F.lower("n_name")).alias("table"),
        F.when(F.col("n_regionkey") == 1, None).otherwise(F.lit("merge_proc")).alias("call"),
        (F.col("n_nationkey") != 7).alias("written"))


_MANIFEST_SQL = """
WITH e AS (
  SELECT lower(n_name) || '.csv' AS file,
         CASE WHEN n_regionkey < 2 THEN 'stage.' || lower(n_name) WHEN n_regionkey = 2 THEN '' ELSE lower(n_name) END AS tbl,
         CASE WHEN n_regionkey = 1 THEN NULL ELSE 'merge_proc' END AS call, n_nationkey <> 7 AS written FROM nation
  WHERE n_nationkey IN (SELECT s_nationkey FROM supplier))
"""


@reg("manifest_write", _MANIFEST_SQL + """
SELECT file, tbl AS "table", coalesce(call, '') AS call FROM e WHERE written AND tbl <> ''""")
def q_manifest_write(spark, sf):
    d = scratch_dir(spark, "manifest")
    K.manifest_write(_manifest_entries(spark, sf), d)
    return spark.read.schema(S.MANIFEST_SCHEMA).json(d).select(F.inline("entries"))


@reg("manifest_read", _MANIFEST_SQL + """
SELECT file, CASE WHEN contains(tbl, '.') THEN split_part(tbl, '.', 1) ELSE 'dflt' END AS schema,
       CASE WHEN contains(tbl, '.') THEN split_part(tbl, '.', 2) ELSE tbl END AS "table",
       coalesce(call, '') AS call FROM e WHERE written AND tbl <> ''""")
def q_manifest_read(spark, sf):
    d = scratch_dir(spark, "manifest")
    K.manifest_write(_manifest_entries(spark, sf), d)
    return S.manifest_read(spark, d, default_schema="dflt")


@reg("result_export", "SELECT CAST(s_suppkey AS INTEGER) AS s_suppkey, s_name, CAST(s_nationkey AS INTEGER) AS s_nationkey FROM supplier")
def q_result_export(spark, sf):
    d = scratch_dir(spark, "export")
    sp = table(spark, sf, "supplier").select("s_suppkey", "s_name", "s_nationkey")
    assert K.result_export(sp, d, "supplier.csv")
    assert not K.result_export(sp.filter(F.col("s_suppkey") < 0), d, "empty.csv")
    return S.csv_scan(spark, f"{d}/supplier.csv")


def _target(spark, sf, name, loc):
    spark.sql(f"CREATE TABLE {name} (s_suppkey BIGINT, s_name STRING, note STRING DEFAULT 'loaded', "
              f"s_nationkey INT) USING parquet LOCATION '{loc}'")
    return name


_TARGET_SQL = ("SELECT CAST(s_suppkey AS BIGINT) AS s_suppkey, s_name, 'loaded' AS note, "
               "CAST(s_nationkey AS INTEGER) AS s_nationkey FROM supplier")


def _read_and_drop(spark, *names):
    """The first table's rows, kept as files; the query leaves no table behind."""
    rows = materialise(spark.table(names[0]), "rows")
    for name in names:
        spark.sql(f"DROP TABLE IF EXISTS {name}")
    return rows


def _suppliers(spark, sf):
    return table(spark, sf, "supplier").select("s_suppkey", "s_name", "s_nationkey")


@reg("table_append", _TARGET_SQL)
def q_table_append(spark, sf):
    d = scratch_dir(spark, "append")
    t = _target(spark, sf, f"tf_target_{uuid.uuid4().hex[:8]}", d)
    K.table_append(spark, _suppliers(spark, sf), t)
    return _read_and_drop(spark, t)


@reg("table_snapshot", _TARGET_SQL)
def q_table_snapshot(spark, sf):
    d = scratch_dir(spark, "snap")
    t = _target(spark, sf, f"tf_target_{uuid.uuid4().hex[:8]}", d + "/t")
    K.table_append(spark, _suppliers(spark, sf), t)
    snap = K.table_snapshot(spark, t, "s1")
    K.table_snapshot(spark, t, "s1")  # second time: cleared and refilled, not doubled
    return _read_and_drop(spark, snap, t)


def _load_setup(spark, sf):
    d = scratch_dir(spark, "load")
    # the delivered result is a partitioned CSV directory (no single-writer file)
    K.result_export(_suppliers(spark, sf), d + "/files", "supplier.csv")
    tname = f"tf_load_{uuid.uuid4().hex[:8]}"
    _target(spark, sf, tname, d + "/t")
    audit = f"tf_audit_{uuid.uuid4().hex[:8]}"
    spark.sql(f"CREATE TABLE {audit} (target STRING, n BIGINT) USING parquet LOCATION '{d}/audit'")
    manifest = spark.createDataFrame([("supplier.csv", "", tname, "merge_proc")],
                                     "file string, schema string, table string, call string")

    def merge_proc(s, target):
        s.sql(f"INSERT INTO {audit} SELECT '{target}', count(*) FROM {target}")

    return d, tname, audit, manifest, {"merge_proc": merge_proc}


@reg("staged_load", _TARGET_SQL)
def q_staged_load(spark, sf):
    d, tname, audit, manifest, hooks = _load_setup(spark, sf)
    status = K.staged_load(spark, manifest, d + "/files", hooks=hooks, snapshot=True)
    bad = status.filter(F.col("status") != "ok").collect()
    if bad:
        raise RuntimeError(str(bad))
    return _read_and_drop(spark, tname, audit)


@reg("after_load", "SELECT count(*) AS n FROM supplier")
def q_after_load(spark, sf):
    d, tname, audit, manifest, hooks = _load_setup(spark, sf)
    K.staged_load(spark, manifest, d + "/files", hooks=hooks)
    return _read_and_drop(spark, audit, tname).select("n")


@reg("load_manifest", _TARGET_SQL)
def q_load_manifest(spark, sf):
    d, tname, audit, _, hooks = _load_setup(spark, sf)
    ent = spark.createDataFrame([("supplier.csv", tname, "merge_proc", True)],
                                "file string, table string, call string, written boolean")
    K.manifest_write(ent, d + "/manifest")
    status = jobs.load_manifest(spark, d + "/manifest", d + "/files", hooks=hooks)
    bad = status.filter(F.col("status") != "ok").collect()
    if bad:
        raise RuntimeError(str(bad))
    return _read_and_drop(spark, tname, audit)


@reg("report_frame", """
WITH g AS (SELECT l_returnflag, coalesce(sum(l_extendedprice), 0) AS total FROM lineitem GROUP BY 1)
SELECT l_returnflag, round(total, 6) AS total, round(total / sum(total) OVER (), 6) AS share FROM g""")
def q_report_frame(spark, sf):
    li = table(spark, sf, "lineitem")
    out = H.report_frame(li, lambda d: C.share_by_group(d, "l_returnflag", "l_extendedprice"))
    return r6(out)


@reg("apply_per_statement", """
WITH s AS (SELECT lower(s_name) AS system, s_suppkey FROM supplier)
SELECT system, 1 AS stmt_no, 'save' AS handler, system || '.csv' AS value FROM s
UNION ALL SELECT system, 1, 'all_len', CAST(length('SELECT ' || CAST(s_suppkey AS VARCHAR) || ' AS k /*{{save:' || system || '.csv}}*/' || chr(10) || ';' || chr(10) || chr(10)) AS VARCHAR) FROM s
UNION ALL SELECT system, 2, 'all_len', CAST(length('SELECT 2 AS b' || chr(10) || ';' || chr(10) || chr(10)) AS VARCHAR) FROM s""")
def q_apply_per_statement(spark, sf):
    sp = table(spark, sf, "supplier")
    scripts = sp.select(F.lower("s_name").alias("system"), F.concat(
        F.lit("SELECT "), F.col("s_suppkey").cast("string"), F.lit(" AS k /*{{save:"), F.lower("s_name"),
        F.lit(".csv}}*/; SELECT 2 AS b;")).alias("text"))
    st = TP.with_directives(TP.formatted_statements(scripts, ["system"]))
    handlers = {
        "save": lambda df: df.withColumn("value", F.col("runtime")["save"]),
        "all_len": lambda df: df.withColumn("value", F.length("sql")),
    }
    return H.apply_per_statement(st, handlers)


@reg("export_results", """
WITH r AS (SELECT lower(r_name) AS fileset, r_regionkey FROM region),
e AS (
  SELECT fileset, 1 AS stmt_no, 'inc.' || fileset || '.csv' AS output, 'count ' || (SELECT count(*) FROM supplier) AS content, 'ok' AS status FROM r
  UNION ALL SELECT fileset, 2, 'sys.' || fileset || '--q.q.sql0002.csv', 'region ' || r_regionkey, 'ok' FROM r
  UNION ALL SELECT fileset, 3, 'sys.' || fileset || '--q.q.sql0003.csv', s_name, 'ok'
    FROM r JOIN nation ON n_regionkey = r_regionkey JOIN supplier ON s_nationkey = n_nationkey
  UNION ALL SELECT fileset, 4, 'sys.' || fileset || '--q.q.sql0004.csv', NULL, 'ok' FROM r
  UNION ALL SELECT fileset, 5, 'sys.' || fileset || '--q.q.sql0005.csv', NULL, 'failed' FROM r)
SELECT fileset, CAST(e.stmt_no AS INTEGER) AS stmt_no, e.output, content, status,
       e.stmt_no = 3 AND content IS NOT NULL AS in_manifest FROM e
UNION ALL SELECT fileset, 3, 'sys.' || fileset || '--q.q.sql0003.csv', NULL, 'ok', false FROM r
  WHERE r_regionkey NOT IN (SELECT n_regionkey FROM nation JOIN supplier ON s_nationkey = n_nationkey)""")
def q_export_results(spark, sf):
    d = scratch_dir(spark, "export-results")
    for t in ("supplier", "nation", "region"):
        table(spark, sf, t).createOrReplaceTempView(t)
    # one script per region (the control table); each statement's result grows with supplier.  An
    # include of two statements, a result for the manifest wrapped in directives, an empty result
    # and a failing statement
    r = table(spark, sf, "region").select(F.lower("r_name").alias("fileset"), F.col("r_regionkey").cast("string").alias("k"))
    scripts = r.select(
        F.lit("sys").alias("system"), "fileset", F.lit("q.q.sql").alias("file"), F.concat(
            F.lit("/*{{file:"), "fileset", F.lit(".sql}}*/ SELECT s_name AS content FROM supplier JOIN nation "
            "ON s_nationkey = n_nationkey WHERE n_regionkey = "), "k", F.lit(" /*{{load:stage.suppliers}}*/; "
            "SELECT r_name AS content FROM region WHERE r_regionkey < 0; SELECT nothing FROM nowhere_at_all;")).alias("text"))
    library = r.select(F.concat("fileset", F.lit(".sql")).alias("name"), F.concat(
        F.lit("SELECT concat('count ', count(*)) AS content FROM supplier /*{{save:inc."), "fileset",
        F.lit(".csv}}*/; SELECT 'region "), "k", F.lit("' AS content")).alias("body"))
    prepared = jobs.prepare_scripts(scripts, ["system", "fileset", "file"], library=library)
    log = jobs.export_results(spark, prepared, d, manifest=d + "/manifest")
    loaded = spark.read.schema(S.MANIFEST_SCHEMA).json(d + "/manifest").select(F.inline("entries")).select(
        F.col("file").alias("output"), F.lit(True).alias("__in"))
    read = spark.read.option("header", True).option("escape", '"').csv(d + "/*.csv").select(
        "content", F.url_decode(F.element_at(F.split(F.col("_metadata.file_path"), "/"), -2)).alias("output"))
    return (log.join(read, "output", "left").join(loaded, "output", "left").select(
        "fileset", "stmt_no", "output", "content", F.substring_index("status", ":", 1).alias("status"),
        F.coalesce("__in", F.lit(False)).alias("in_manifest")))


@reg("return_data", f"SELECT {_CUST_SQL}, c_custkey % 2 AS part, CASE c_custkey % 2 WHEN 0 THEN 'stage.customers' ELSE 'part1' END AS target, "
     "CASE c_custkey % 2 WHEN 0 THEN 'merge_customers()' ELSE '' END AS call FROM customer")
def q_return_data(spark, sf):
    d = scratch_dir(spark, "return")
    c = table(spark, sf, "customer").select(
        "c_custkey", F.concat(F.lit(" "), "c_name").alias("c_name"), "c_nationkey", "c_acctbal", "c_mktsegment")
    for part, sep in ((0, "|~|"), (1, ";")):
        _csv(c.filter(F.col("c_custkey") % 2 == part), f"{d}/in/part{part}", sep=sep)
    # the statement behind the first result says where it is loaded, with a placeholder to fill in
    script = spark.range(1).select(F.lit("s").alias("system"), F.lit("f").alias("fileset"), F.lit("q.sql").alias("file"), F.lit(
        "SELECT 1 /*{{save:part0.csv}}*/ /*{{load:{db}.customers}}*/ /*{{call:merge_customers()}}*/; SELECT 2 /*{{save:part1.csv}}*/;").alias("text"))
    keys = ["system", "fileset", "file"]
    subs = script.select(*keys, F.lit(1).alias("priority"), F.lit(0).alias("pos"), F.lit("db").alias("key"), F.lit("stage").alias("value"))
    entries = jobs.statement_entries(jobs.prepare_scripts(script, keys), keys, RG.ordered_layers(subs, keys))
    seen = []
    jobs.return_data(spark, d + "/in", d + "/out", on_result=lambda name, df: seen.append(name),
                     handlers={"part1": lambda df: df}, manifest=d + "/manifest", entries=entries)
    listed = spark.read.schema(S.MANIFEST_SCHEMA).json(d + "/manifest").select(F.inline("entries")).select(
        F.substring_index("file", ".", 1).alias("of"), F.col("table").alias("target"), "call")
    both = [S.csv_scan(spark, x).withColumn("part", F.lit(i)) for i, x in enumerate(sorted(seen))]
    rows = both[0].unionByName(both[1])
    return r6(rows.join(listed, F.concat(F.lit("part"), "part") == F.col("of")).drop("of"))


@reg("drop_folder_stream", """
SELECT CAST(c_custkey AS INTEGER) AS c_custkey, c_name, c_mktsegment, 'sys1' AS system, lower(c_mktsegment) AS fileset,
       'customers' || c_custkey % 4 || '.csv' AS name FROM customer""")
def q_drop_folder_stream(spark, sf):
    from ..streaming.dropfolder import drop_folder_stream
    src = _drop_folder(spark, sf, layouts=False)
    d = scratch_dir(spark, "drop-stream")
    schema = "c_custkey int, c_name string, c_mktsegment string"
    drop_folder_stream(spark, src, d + "/out", d + "/ckpt", schema)
    # a second run over the same folder loads nothing twice
    drop_folder_stream(spark, src, d + "/out", d + "/ckpt", schema)
    return spark.read.parquet(d + "/out").select("c_custkey", "c_name", "c_mktsegment", "system", "fileset", "name")


@reg("post_work", """
SELECT s_name AS script, CAST(s_nationkey AS INTEGER) AS nation,
       round(CASE WHEN s_nationkey = 1 THEN -s_acctbal ELSE s_acctbal END, 6) AS balance
FROM supplier WHERE s_nationkey <> 2 OR s_acctbal > 0""")
def q_post_work(spark, sf):
    # results of the scripts of two nations go through post-work of their own, the others do not
    results = table(spark, sf, "supplier").select(F.concat(F.lit("n"), "s_nationkey").alias("nation_script"),
                                                  F.col("s_name").alias("script"), F.col("s_nationkey").alias("nation"),
                                                  F.col("s_acctbal").alias("balance"))
    out = H.post_work(results, {"n1": lambda df: df.withColumn("balance", -F.col("balance")),
                                "n2": lambda df: df.filter("balance > 0")}, script="nation_script")
    return r6(out.select("script", "nation", "balance"))


@reg("grouped_post_work", """
WITH r AS (SELECT 'n' || CAST(s_nationkey AS VARCHAR) AS nation_script, s_name AS script, s_nationkey AS nation, s_acctbal AS balance FROM supplier)
SELECT nation_script, script, CAST(nation AS INTEGER) AS nation, round(CASE WHEN nation = 1 THEN -balance ELSE balance END, 6) AS balance
FROM r WHERE nation <> 3 AND (nation <> 2 OR balance > 0)
UNION ALL SELECT nation_script, max(script), CAST(3 AS INTEGER), round(max(balance), 6) FROM r WHERE nation = 3 GROUP BY 1
UNION ALL SELECT NULL, s_name, CAST(s_nationkey AS INTEGER), round(s_acctbal, 6) FROM supplier""")
def q_grouped_post_work(spark, sf):
    import pyarrow as pa
    import pyarrow.compute as pc

    sp = table(spark, sf, "supplier")
    cols = [F.col("s_name").alias("script"), F.col("s_nationkey").alias("nation"), F.col("s_acctbal").alias("balance")]
    results = sp.select(F.concat(F.lit("n"), F.col("s_nationkey").cast("string")).alias("nation_script"), *cols).unionByName(
        sp.select(F.lit(None).cast("string").alias("nation_script"), *cols))

    def negated(t: pa.Table) -> pa.Table:
        return t.set_column(t.column_names.index("balance"), "balance", pc.negate(t.column("balance")))

    def largest(t: pa.Table) -> pa.Table:
        one = t.slice(0, 1)
        for c in ("script", "balance"):
            one = one.set_column(one.column_names.index(c), c, pa.array([pc.max(t.column(c)).as_py()], t.schema.field(c).type))
        return one

    out = H.grouped_post_work(results, {
        "n1": H.GroupHandler(negated), "n2": H.GroupHandler(lambda t: t.filter(pc.greater(t.column("balance"), 0))),
        "n3": H.GroupHandler(largest, merge=largest)}, script="nation_script")
    return r6(out)


@reg("exactly_once_load", """
SELECT CAST(s_suppkey AS BIGINT) AS s_suppkey, s_name, 'loaded' AS note, CAST(s_nationkey AS INTEGER) AS s_nationkey,
  CAST(2 AS BIGINT) AS n_hook_runs, 'failed|ok|done before' AS statuses FROM supplier""")
def q_exactly_once_load(spark, sf):
    d = scratch_dir(spark, "once")
    K.result_export(_suppliers(spark, sf), d + "/files", "supplier.csv")
    tail = uuid.uuid4().hex[:8]
    target, ledger = f"tf_once_{tail}", L.create_ledger(spark, f"tf_ledger_{tail}", d + "/ledger")
    spark.sql(f"CREATE TABLE {target} (s_suppkey BIGINT, s_name STRING, note STRING DEFAULT 'loaded', s_nationkey INT, "
              f"load_id STRING) USING parquet PARTITIONED BY (load_id) LOCATION '{d}/t'")
    manifest = spark.createDataFrame([("supplier.csv", "", target, "merge_proc")],
                                     "file string, schema string, table string, call string")
    runs = []

    def merge_proc(session, name):
        runs.append(name)
        if len(runs) == 1:
            raise RuntimeError("the hook fails the first time")

    # a load whose hook fails, the rerun, and a rerun of what is done
    statuses = [L.exactly_once_load(spark, manifest, d + "/files", ledger, "m1", {"merge_proc": merge_proc}).first()["status"]
                for _ in range(3)]
    # a load that was cut short after its rows were written, and forgotten by the ledger
    key = spark.table(ledger).first()["load_id"]
    spark.sql(f"ALTER TABLE {ledger} DROP PARTITION (load_id = '{key}', step = 'loaded')")
    L.exactly_once_load(spark, manifest, d + "/files", ledger, "m1", {"merge_proc": merge_proc})
    rows = _read_and_drop(spark, target, ledger).drop("load_id")
    return rows.withColumns({"n_hook_runs": F.lit(len(runs)).cast("long"), "statuses": F.lit("|".join(statuses))})
