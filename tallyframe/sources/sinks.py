"""Sinks (S10-S14): result export, load manifest, table append/snapshot and staged loads.

Writes are Spark writers (partitioned, executor-side).  Table operations are Spark SQL
statements against the session catalog.
"""

from __future__ import annotations

import datetime as dt
import json
import uuid
from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import clean
from .files import MANIFEST_SCHEMA, csv_scan


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def publish_single_file(spark: SparkSession, written_dir: str, target: str, suffix: str = ".csv") -> str:
    """Rename the single part file of ``written_dir`` to ``target`` (Hadoop FS rename).

    Only for outputs that were coalesced to one partition because a consumer needs one
    named file (report-sized results); large results stay partitioned directories.
    """
    src_dir, fs = _fs(spark, written_dir)
    parts = [st.getPath() for st in fs.listStatus(src_dir) if st.getPath().getName().startswith("part-")
             and st.getPath().getName().endswith(suffix)]
    if len(parts) != 1:
        raise ValueError(f"expected one part file in {written_dir}, found {len(parts)}")
    dst, _ = _fs(spark, target)
    fs.delete(dst, False)
    fs.rename(parts[0], dst)
    fs.delete(src_dir, True)
    return target


# S10 -----------------------------------------------------------------------------------
def result_export(df: DataFrame, out_dir: str, name: str, single_file: bool = False) -> bool:
    """Write ``df`` as header CSV named ``name`` under ``out_dir`` only if it has rows.

    The query runs once: its rows are counted while they are written, and an empty output is
    withdrawn (an earlier output of that name is gone then, too).  By default the result is a
    partitioned CSV directory called ``name``; ``single_file`` produces one file of that name
    (one writer task - for report-sized results only).
    """
    from ..plans.observed import write_if_any

    target = f"{out_dir.rstrip('/')}/{name}"

    def write(rows: DataFrame, path: str) -> None:
        rows.write.mode("overwrite").option("header", True).option("escape", '"').csv(path)

    if not single_file:
        return write_if_any(df, target, write) > 0
    if not write_if_any(df.coalesce(1), target + ".__tmp", write):
        return False
    publish_single_file(df.sparkSession, target + ".__tmp", target)
    return True


def exported(spark: SparkSession, path: str, schema) -> DataFrame:
    """An exported result, read back with the types it had."""
    return spark.read.option("header", True).option("escape", '"').schema(schema).csv(path)


# S11 -----------------------------------------------------------------------------------
def manifest_write(entries: DataFrame, path: str) -> DataFrame:
    """One manifest entry per exported, load-flagged result: {"entries": [{file,table,call}]}.

    ``entries``: (file, table, call, written).  Rows that were not written (empty
    results) or carry no table are left out; a missing call becomes ''.
    """
    e = entries.filter(F.col("written") & F.col("table").isNotNull() & (F.col("table") != ""))
    doc = e.agg(F.array_sort(F.collect_list(F.struct(
        F.col("file"), F.col("table"), F.coalesce(F.col("call"), F.lit("")).alias("call")))).alias("entries"))
    out = doc.select(F.to_json(F.struct(F.coalesce("entries", F.array().cast(
        MANIFEST_SCHEMA["entries"].dataType)).alias("entries"))).alias("value"))
    out.coalesce(1).write.mode("overwrite").text(path)
    return out


# S12 -----------------------------------------------------------------------------------
def table_append(spark: SparkSession, df: DataFrame, table: str) -> None:
    """Insert by column name; target columns the frame lacks take their declared default."""
    view = f"tf_append_{uuid.uuid4().hex}"
    df.createOrReplaceTempView(view)
    try:
        spark.sql(f"INSERT INTO {table} BY NAME SELECT * FROM {view}")
    finally:
        spark.catalog.dropTempView(view)


# S13 -----------------------------------------------------------------------------------
def table_snapshot(spark: SparkSession, table: str, suffix: str) -> str:
    """Copy ``table`` to ``<table>_<suffix>``; an existing copy is cleared and refilled."""
    snap = f"{table}_{suffix}"
    if spark.catalog.tableExists(snap):
        spark.sql(f"INSERT OVERWRITE TABLE {snap} SELECT * FROM {table}")
    else:
        spark.sql(f"CREATE TABLE {snap} USING parquet AS SELECT * FROM {table}")
    return snap


def snapshot_suffix(now: dt.datetime | None = None) -> str:
    return (now or dt.datetime.now()).strftime("%m%d%Y%H%M")


# S14 -----------------------------------------------------------------------------------
def staged_load(spark: SparkSession, manifest: DataFrame, base_dir: str,
                hooks: Mapping[str, Callable[[SparkSession, str], None]] | None = None,
                snapshot: bool = False, suffix: str | None = None) -> DataFrame:
    """Load every manifest entry: read its CSV, NaN → null, drop index columns, append by
    name, optionally snapshot the loaded target; run the entry's ``call`` hook only after
    a successful append; drop the snapshot when all went well (a hook that fails leaves it).

    The manifest is streamed to the driver entry by entry; every load itself is
    a distributed read and insert.  Returns a status row per entry; a failed entry
    reports the first rows of its file and the target's columns in order.
    """
    hooks = dict(hooks or {})
    suffix = suffix or snapshot_suffix()
    results = []
    for e in manifest.toLocalIterator():
        target = f"{e['schema']}.{e['table']}" if e["schema"] else e["table"]
        path = f"{base_dir.rstrip('/')}/{e['file']}"
        snap = None
        try:
            df = clean.drop_unnamed(clean.nan_to_null(csv_scan(spark, path)))
            table_append(spark, df, target)
            if snapshot:
                snap = table_snapshot(spark, target, suffix)
            if e["call"]:
                hook = hooks.get(e["call"])
                if hook is None:
                    raise KeyError(f"no hook registered for call {e['call']!r}")
                hook(spark, target)
            if snap:
                spark.sql(f"DROP TABLE IF EXISTS {snap}")
            results.append((e["file"], target, "ok", None))
        except Exception as exc:  # noqa: BLE001 - reported per entry, the run continues
            cols = [c.name for c in spark.catalog.listColumns(target)] if spark.catalog.tableExists(target) else []
            results.append((e["file"], target, "failed", f"{type(exc).__name__}: {exc}; target columns: {cols}; "
                            f"first rows: {_first_rows(spark, base_dir, e['file'])}"))
    return spark.createDataFrame(results, "file string, target string, status string, detail string")


def _first_rows(spark: SparkSession, base_dir: str, file: str) -> str:
    try:
        return json.dumps([r.asDict() for r in failure_preview(spark, base_dir, file).collect()], default=str)
    except Exception as exc:  # noqa: BLE001 - the file itself may be what is missing
        return f"unreadable ({type(exc).__name__})"


def failure_preview(spark: SparkSession, base_dir: str, file: str, n: int = 10) -> DataFrame:
    """First rows of a file that failed to load (for the report)."""
    return csv_scan(spark, f"{base_dir.rstrip('/')}/{file}").limit(n)
