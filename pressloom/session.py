"""Spark session and checkpoint-directory helpers."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession


def get_spark(master: str | None = None, shuffle_partitions: int = 8, app: str = "pressloom") -> SparkSession:
    """Session used by tests and the bench. On a cluster the caller passes its own session."""
    builder = (
        SparkSession.builder.master(master or "local[8]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", os.environ.get("PRESSLOOM_DRIVER_MEMORY", "16g"))
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    checkpoint_dir(spark)
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """Reliable checkpoint directory for lineage cuts.

    Uses the directory the cluster names in ``spark.checkpoint.dir``. Only a
    local session without one gets a fresh scratch directory (tests, bench);
    a cluster session without it is an error, since a machine-local folder
    would not survive the loss of an executor.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = sc.getConf().get("spark.checkpoint.dir", None)
    if configured:
        sc.setCheckpointDir(configured)
        return sc.getCheckpointDir()
    if not sc.master.startswith("local"):
        raise RuntimeError("spark.checkpoint.dir must name a shared folder on a cluster")
    sc.setCheckpointDir(tempfile.mkdtemp(prefix="pressloom-ckpt-", dir="/tmp"))
    return sc.getCheckpointDir()
