"""Session helpers: a shared working folder and a builder for local runs."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession


def shared_dir(spark: SparkSession) -> str:
    """The shared folder the cluster names in ``spark.checkpoint.dir``.

    On a cluster this setting points at shared storage every executor can
    reach. Only with a local master (tests) do we create one where it is unset.
    """
    path = spark.conf.get("spark.checkpoint.dir", None)
    if not path:
        try:
            path = spark.sparkContext.getCheckpointDir()
        except Exception:  # pragma: no cover - Spark Connect has no context
            path = None
    if not path:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        path = tempfile.mkdtemp(prefix="slotwise-ckpt-")
        spark.sparkContext.setCheckpointDir(path)
    return path


def run_dir(spark: SparkSession, label: str) -> str:
    """A fresh sub-folder of the shared folder for one run of one job."""
    base = shared_dir(spark).rstrip("/")
    return f"{base}/slotwise/{label}-{uuid.uuid4().hex[:12]}"


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "slotwise") -> SparkSession:
    """Session for tests and the local bench (cluster jobs get theirs from the platform)."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", os.environ.get("SLOTWISE_DRIVER_MEMORY", "8g"))
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        # Whole-stage code is compiled on the driver; the default cache (100
        # classes) is smaller than one run of the gold queries, so repeated
        # runs recompiled most stages. A cluster config would set this too.
        .config("spark.sql.codegen.cache.maxEntries", "2000")
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    shared_dir(spark)
    return spark
