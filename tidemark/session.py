"""Session settings and the shared scratch folder.

Every job in this package assumes a UTC session clock: event times are UTC
instants and the silver layer stores them as naive UTC wall-clock values
(``timestamp_ntz``). ``configure`` sets that plus adaptive execution on a
session someone else built (the driver's, a notebook's); ``local_session``
builds one for tests and the bench.
"""

from __future__ import annotations

import os
import re
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings every query relies on. Runtime SQL confs only, so they can be
# applied to an existing session.
_RUNTIME_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # A shuffled join whose side turns out small at runtime becomes a
    # broadcast join; this is the size check behind every semi join here. Each
    # such side passes through the driver, and a refresh has several: key sets
    # that grow with the batch stay shuffled.
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "8MB",
    # Kept rows are cut into few tasks like any others, so that each table
    # written from them does not start hundreds.
    "spark.sql.optimizer.canChangeCachedPlanOutputPartitioning": "true",
}
# Bytes that one task is dealt, at most. Both are sizes of packed columns, and
# a task that sorts or groups them holds some forty times as much: rows of a
# key each unpack to that. A session's own smaller values stay.
_MOST_PER_TASK = {
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": 16 << 20,
    "spark.sql.files.maxPartitionBytes": 32 << 20,
}


def configure(spark: SparkSession) -> SparkSession:
    for key, value in _RUNTIME_CONF.items():
        spark.conf.set(key, value)
    as_bytes = spark.sparkContext._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes
    for key, most in _MOST_PER_TASK.items():
        if as_bytes(spark.conf.get(key)) > most:
            spark.conf.set(key, f"{most}b")
    return spark


def local_session(cores: int | str = "*", shuffle_partitions: int = 8,
                  app: str = "tidemark") -> SparkSession:
    """A local session for tests and the bench (UI off, UTC, AQE on)."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", os.environ.get("TIDEMARK_DRIVER_MEMORY", "16g"))
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        # Local disks only: skip the .crc side file the checksummed local
        # filesystem writes next to every output file (cluster stores have none).
        .config("spark.hadoop.fs.file.impl", "org.apache.hadoop.fs.RawLocalFileSystem")
    )
    spark = configure(builder.getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The cluster's shared folder: ``spark.checkpoint.dir`` of the session.

    A session of one process (``local[...]``: tests, bench) that names none
    gets a folder of its own. On a cluster an unset folder is an error, as a
    machine-local one would hide each executor's files from the others.
    """
    sc = spark.sparkContext
    base = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not base:
        if not re.fullmatch(r"local(\[[^\]]*\])?", sc.master):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        base = tempfile.mkdtemp(prefix="tidemark-ckpt-")
        sc.setCheckpointDir(base)
    elif sc.getCheckpointDir() is None:
        sc.setCheckpointDir(base)
    return base.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, never-reused folder under the shared folder for one run."""
    return f"{shared_dir(spark)}/tidemark/{name}-{uuid.uuid4().hex}"
