"""Session helpers: a local session for tests/bench and the shared folder for materialised tables."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "trendlens") -> SparkSession:
    """A local session as used by tests and the bench (no UI, AQE on, UTC)."""
    builder = (SparkSession.builder.master(f"local[{cores}]").appName(app)
               .config("spark.ui.enabled", "false")
               .config("spark.ui.showConsoleProgress", "false")
               .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
               .config("spark.sql.adaptive.enabled", "true")
               .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
               .config("spark.sql.adaptive.skewJoin.enabled", "true")
               .config("spark.sql.session.timeZone", "UTC")
               .config("spark.driver.memory", os.environ.get("TRENDLENS_DRIVER_MEMORY", "16g")))
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder named by `spark.checkpoint.dir`.

    On a cluster this must be set (a shared file system). Only a local master (tests, bench) may leave
    it unset; a folder is then made and registered as the checkpoint dir.
    """
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not root:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        root = tempfile.mkdtemp(prefix="trendlens-ckpt-")
        spark.sparkContext.setCheckpointDir(root)
        root = spark.sparkContext.getCheckpointDir() or root
    return root.rstrip("/")


def scratch_path(spark: SparkSession, *parts: str) -> str:
    """A fresh path under the checkpoint root, unique per application and call."""
    app = spark.sparkContext.applicationId
    return "/".join([checkpoint_root(spark), "trendlens", app, *parts, uuid.uuid4().hex[:12]])
