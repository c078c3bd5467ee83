"""Land new raw files incrementally: each run picks up only files not seen before.

The same bronze landing as the batch path (S1/S2 -> S4), expressed as a file
stream with an ``availableNow`` trigger: the checkpoint records which files were
landed, so a rerun after new files arrive (or after a failed run) adds exactly
the missing ones. Runs as a batch-like job; no long-lived service.
"""

from __future__ import annotations

from pyspark.sql import SparkSession
from pyspark.sql.types import StructType


def land_files(spark: SparkSession, source_dir: str, schema: StructType | str, target_dir: str, checkpoint_dir: str,
               fmt: str = "parquet", options: dict | None = None, partition_by=None,
               max_files_per_trigger: int | None = None) -> str:
    """Append every not-yet-landed file under ``source_dir`` to ``target_dir``."""
    r = spark.readStream.schema(schema).format(fmt)
    for k, v in (options or {}).items():
        r = r.option(k, v)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    w = (r.load(source_dir).writeStream.format("parquet").outputMode("append")
         .option("checkpointLocation", checkpoint_dir).option("path", target_dir)
         .trigger(availableNow=True))
    if partition_by:
        w = w.partitionBy(*partition_by)
    q = w.start()
    q.awaitTermination()
    if q.exception() is not None:
        raise RuntimeError(str(q.exception()))
    return target_dir
