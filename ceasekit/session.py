"""SparkSession construction with settings that hold from local[8] to a cluster."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession


def get_spark(master: str | None = None, app: str = "ceasekit",
              shuffle_partitions: int | None = None, extra: dict | None = None) -> SparkSession:
    """Return the active session or build one.

    On a cluster the session already exists (spark-submit) and only the
    checkpoint directory is filled in when the cluster did not name one.
    """
    active = SparkSession.getActiveSession()
    if active is not None:
        ensure_checkpoint_dir(active)
        return active
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    conf = {
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        # driver and Python workers talk over files instead of local ports: less delay in iterative jobs
        "spark.python.unix.domain.socket.enabled": "true",
        # plan-time estimates come from compressed file sizes: keep them to Spark's 10 MB;
        # AQE broadcasts a side up to 32 MB measured on its materialised shuffle output
        "spark.sql.autoBroadcastJoinThreshold": str(10 * 1024 * 1024),
        "spark.sql.adaptive.autoBroadcastJoinThreshold": str(32 * 1024 * 1024),
        "spark.driver.memory": os.environ.get("CEASEKIT_DRIVER_MEMORY", "8g"),
    }
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Use the cluster's ``spark.checkpoint.dir``. A scratch folder stands in for it in local mode only:
    on a cluster each executor would write to its own disk."""
    sc = spark.sparkContext
    cur = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not cur:
        if not sc.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        cur = tempfile.mkdtemp(prefix="ceasekit-ckpt-")
        spark.conf.set("spark.checkpoint.dir", cur)
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(cur)
    return cur
