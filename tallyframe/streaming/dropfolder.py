"""S8 as an incremental job: a drop folder read with Structured Streaming.

Files are routed by their ``system.fileset.name.csv`` names and appended, partitioned by
(system, fileset), to a parquet table.  ``availableNow`` processes whatever has arrived and
stops; the checkpoint remembers which files were loaded, so a rerun (or a restarted
driver after a lost executor) picks up only new files and never loads one twice.
"""

from __future__ import annotations

from pyspark.sql import SparkSession
from pyspark.sql import types as T

from ..sources.files import route_drop_files


def drop_folder_stream(spark: SparkSession, folder: str, out: str, checkpoint: str,
                       schema: T.StructType | str, max_files_per_trigger: int | None = None):
    """Start (and wait for) an ``availableNow`` load of ``folder`` into ``out``."""
    rd = spark.readStream.schema(schema).option("header", True).option("escape", '"')
    if max_files_per_trigger:
        rd = rd.option("maxFilesPerTrigger", max_files_per_trigger)
    routed = route_drop_files(rd.csv(folder))
    q = (routed.writeStream.format("parquet").partitionBy("system", "fileset")
         .option("checkpointLocation", checkpoint).outputMode("append")
         .trigger(availableNow=True).start(out))
    q.awaitTermination()
    return q
