"""Spark session helpers.

The session never picks its own scratch space when the cluster names one:
``spark.checkpoint.dir`` is read from the session and only filled in when
it is unset (local runs and tests).
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

BASE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # remove checkpoint files of hot-key slices once their plans are gone
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def get_session(master: str | None = None, shuffle_partitions: int = 8,
                app: str = "walletyield", extra: dict | None = None) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    conf = dict(BASE_CONF)
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.setdefault("spark.driver.memory", os.environ.get("WY_DRIVER_MEMORY", "16g"))
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder, creating a local one only if unset."""
    sc = spark.sparkContext
    path = sc.getConf().get("spark.checkpoint.dir", None)
    if path:
        return path
    existing = sc.getCheckpointDir()
    if existing:
        return existing
    if not sc.master.startswith("local"):
        # on a cluster a driver-local folder is invisible to the executors
        raise RuntimeError("set spark.checkpoint.dir to a shared folder for this cluster")
    sc.setCheckpointDir(tempfile.mkdtemp(prefix="wy-ckpt-"))
    return sc.getCheckpointDir()


def scratch_path(spark: SparkSession, name: str) -> str:
    """A path under the shared checkpoint folder for written intermediate tables."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/{name}"


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions", "200"))
