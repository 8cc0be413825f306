"""Session helpers: a local session for tests/bench and the shared work folder.

On a cluster the work folder is whatever ``spark.checkpoint.dir`` names (a
shared file system every executor can reach).  Only a local master may fall
back to a private temporary folder.
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession


def local_session(cpus: int | str = "*", shuffle_partitions: int = 8, app: str = "trolley") -> SparkSession:
    """A local session with the settings every test and the bench use."""
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", os.environ.get("TROLLEY_DRIVER_MEMORY", "8g"))
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    work_dir(spark)
    return spark


def size_shuffles(spark: SparkSession, input_bytes: int, target_bytes: int = 128 << 20) -> int:
    """Start AQE's shuffles wide enough for the input (about ``target_bytes`` per partition) and let it
    coalesce down; only when the session does not set the initial width itself.  Returns the width."""
    key = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
    if spark.conf.get(key, None):
        return int(spark.conf.get(key))
    width = max(int(spark.conf.get("spark.sql.shuffle.partitions", "200")), -(-input_bytes // target_bytes))
    spark.conf.set(key, str(width))
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", str(target_bytes))
    return width


def work_dir(spark: SparkSession) -> str:
    """Shared folder for materialised tables and streaming checkpoints.

    Read from the session (``spark.checkpoint.dir`` or the context's
    checkpoint dir).  When unset, a local master gets a fresh temp folder;
    a cluster master must name one explicitly.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = sc.getConf().get("spark.checkpoint.dir", None) or spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        sc.setCheckpointDir(configured)
        return sc.getCheckpointDir() or configured
    if not sc.master.startswith("local"):
        raise RuntimeError(
            "spark.checkpoint.dir is not set; point it at a shared folder (HDFS/S3/ABFS) "
            "before building the warehouse on a cluster"
        )
    path = tempfile.mkdtemp(prefix="trolley-work-")
    sc.setCheckpointDir(path)
    return sc.getCheckpointDir() or path
