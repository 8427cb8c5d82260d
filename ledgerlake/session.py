"""Session settings and the shared work folder.

Every job reads the shared folder from ``spark.checkpoint.dir``. A folder is
only created here when that setting is unset, which happens in local runs and
tests; on a cluster the setting must name shared storage.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings every job relies on: UTC wall clock, ANSI arithmetic, adaptive
# execution (runtime broadcast, partition coalescing, skew-join splitting).
SESSION_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.parquet.filterPushdown": "true",
}


def build_session(master: str = "local[*]", shuffle_partitions: int = 8,
                  app_name: str = "ledgerlake") -> SparkSession:
    """Session for local runs and tests (UI off, no extra ports)."""
    builder = (
        SparkSession.builder.master(master)
        .appName(app_name)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", "8g")
        # static: skip capturing the Python call site of every DataFrame call
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
    )
    for key, value in SESSION_CONF.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    apply_conf(spark)
    return spark


def apply_conf(spark: SparkSession) -> None:
    for key, value in SESSION_CONF.items():
        spark.conf.set(key, value)


def shared_dir(spark: SparkSession) -> str:
    """The cluster-wide folder for checkpoints and written tables.

    Read from ``spark.checkpoint.dir``; set to a fresh local folder only when
    unset and the master is local (tests, single-machine runs).
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current is None:
        current = spark.conf.get("spark.checkpoint.dir", None)
        if current:
            sc.setCheckpointDir(current)
    if current is None:
        if not sc.master.startswith("local"):
            raise RuntimeError(
                "spark.checkpoint.dir must name shared storage on a cluster")
        current = tempfile.mkdtemp(prefix="ledgerlake-ckpt-")
        sc.setCheckpointDir(current)
        current = sc.getCheckpointDir()
    return current.rstrip("/")


def scratch_path(spark: SparkSession, *parts: str) -> str:
    """A new folder under the shared directory, unique per call."""
    base = shared_dir(spark)
    name = "/".join(parts) if parts else "run"
    return f"{base}/ledgerlake/{name}-{uuid.uuid4().hex[:12]}"


def local_path(path: str) -> str:
    """Strip a ``file:`` scheme so Python can open local paths in tests."""
    if path.startswith("file:"):
        path = path[len("file:"):]
        while path.startswith("//"):
            path = path[1:]
    return os.path.abspath(path)
