"""Exactly-once loads (S12-S14): a ledger, and one partition of the target per load.

Every entry of a manifest has a load id, made of the manifest's name, the file and the table.  Its rows
live in the target's partition of that id, and loading overwrites the partition, so a load that is
run again, or run after one that was cut short, leaves the same rows as one that ran once.  The
ledger records what has been finished; the append and its hook are recorded apart, so a failing
hook is run again without a second append.  Ledger entries are partitions too: recording one twice
is recording it once.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import clean
from .files import csv_scan

#: The target's partition column, and the steps that the ledger knows.
LOAD_ID = "load_id"
LOADED, HOOKED = "loaded", "hooked"


def load_id(name: str):
    """Id of each entry of the manifest called ``name``."""
    return F.md5(F.concat_ws("\n", F.lit(name), "file", F.coalesce("schema", F.lit("")), "table"))


def create_ledger(spark: SparkSession, table: str, path: str | None = None) -> str:
    """The ledger's table, if there is none yet: one partition per (load id, step)."""
    where = f" LOCATION '{path}'" if path else ""
    spark.sql(f"CREATE TABLE IF NOT EXISTS {table} (file STRING, target STRING, version STRING, n BIGINT, "
              f"{LOAD_ID} STRING, step STRING) USING parquet PARTITIONED BY ({LOAD_ID}, step){where}")
    return table


def _record(spark: SparkSession, ledger: str, key: str, step: str, file: str, target: str, version: str, n: int) -> None:
    spark.sql(f"INSERT OVERWRITE TABLE {ledger} PARTITION ({LOAD_ID} = '{key}', step = '{step}') "
              "SELECT :file AS file, :target AS target, :version AS version, :n AS n",
              args={"file": file, "target": target, "version": version, "n": n})


def file_version(spark: SparkSession, path: str) -> str:
    """What tells one delivery of a file from the next: its parts' sizes and times, by Spark's file source."""
    parts = spark.read.format("binaryFile").load(path).select(
        F.element_at(F.split("path", "/"), -1).alias("name"), "length", "modificationTime")
    return parts.agg(F.concat_ws(":", F.count("*"), F.sum("length"), F.max("modificationTime"), F.bit_xor(
        F.xxhash64("name", "length", "modificationTime")))).first()[0]


def overwrite_load(spark: SparkSession, df: DataFrame, target: str, key: str) -> int:
    """Put ``df`` into the target's partition ``key``, whatever it held; returns the rows written.

    Columns go by name; those that the frame lacks take their declared default.  The rows are
    counted while they are written, so the source is read once.
    """
    from ..plans.observed import counted

    view = f"tf_load_{key}"
    rows, count = counted(df)
    rows.createOrReplaceTempView(view)
    try:
        spark.sql(f"INSERT OVERWRITE TABLE {target} PARTITION ({LOAD_ID} = '{key}') BY NAME SELECT * FROM {view}")
    finally:
        spark.catalog.dropTempView(view)
    return count()


def exactly_once_load(spark: SparkSession, manifest: DataFrame, base_dir: str, ledger: str, name: str,
                      hooks: Mapping[str, Callable[[SparkSession, str], None]] | None = None) -> DataFrame:
    """Load every entry of the manifest ``name`` once, however often this is run.

    ``manifest``: (file, schema, table, call) with each (file, table) once; targets are partitioned by ``load_id``.
    A file delivered anew, with other parts, replaces its rows and has its hook run again.  A hook is run
    until it succeeds, and not after that.  Returns (file, target, status, detail): status is ``ok``,
    ``done before`` or ``failed``; a failed entry does not stop the others.

    The driver walks the manifest's entries; every load is a distributed read and write.
    """
    hooks, results = dict(hooks or {}), []
    entries = manifest.withColumn(LOAD_ID, load_id(name))
    known = spark.table(ledger).select(LOAD_ID, "step", "version").alias("l")
    # the ledger's lines of this manifest's entries only
    past = {(r[LOAD_ID], r["step"]): r["version"] for r in known.join(
        entries.select(LOAD_ID).distinct(), LOAD_ID, "left_semi").toLocalIterator()}
    for e in entries.toLocalIterator():
        target = f"{e['schema']}.{e['table']}" if e["schema"] else e["table"]
        path, key = f"{base_dir.rstrip('/')}/{e['file']}", e[LOAD_ID]
        status = "done before"
        try:
            version = file_version(spark, path)
            if past.get((key, LOADED)) != version:
                df = clean.drop_unnamed(clean.nan_to_null(csv_scan(spark, path)))
                n = overwrite_load(spark, df, target, key)
                _record(spark, ledger, key, LOADED, e["file"], target, version, n)
                status = "ok"
            if e["call"] and past.get((key, HOOKED)) != version:
                hook = hooks.get(e["call"])
                if hook is None:
                    raise KeyError(f"no hook registered for call {e['call']!r}")
                hook(spark, target)
                _record(spark, ledger, key, HOOKED, e["file"], target, version, 0)
                status = "ok"
            results.append((e["file"], target, status, None))
        except Exception as exc:  # noqa: BLE001 - reported per entry, the run continues
            results.append((e["file"], target, "failed", f"{type(exc).__name__}: {str(exc)[:500]}"))
    return spark.createDataFrame(results, "file string, target string, status string, detail string")
