"""Session helpers: the caller owns the session; these only read or fill config."""

from __future__ import annotations

import os
import re
import tempfile
import uuid

from pyspark.sql import SparkSession


def local_session(cores: int | str = "*", shuffle_partitions: int = 8,
                  app: str = "pitlane") -> SparkSession:
    """A local session for tests and benchmarks (a cluster passes its own config)."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.parallelismFirst", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
        .config("spark.driver.memory", os.environ.get("PITLANE_DRIVER_MEMORY", "8g"))
        .config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="pitlane-ckpt-"))
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by ``spark.checkpoint.dir``.

    A cluster has to name one on shared storage; without it this raises.  Only a
    local session, as in tests, gets a fresh folder of its own.
    """
    sc = spark.sparkContext
    if sc.getCheckpointDir() is None:
        path = sc.getConf().get("spark.checkpoint.dir", None)
        if not path and not re.fullmatch(r"local(\[(\d+|\*)(,\s*\d+)?\])?", sc.master):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        sc.setCheckpointDir(path or tempfile.mkdtemp(prefix="pitlane-ckpt-"))
    return sc.getCheckpointDir()


def scratch_path(spark: SparkSession, name: str) -> str:
    """A unique folder under the shared checkpoint dir, for written tables."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/pitlane-{name}-{uuid.uuid4().hex[:12]}"
