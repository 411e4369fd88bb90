"""Session helpers: configuration the library relies on, and the shared work folder."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

# Input bytes of one scan task. Above 200 partitions a shuffle sorts what a task sends in memory, some 180 bytes
# for a sample that has 12 in its file: the task that sends must be small as well, not only the one that receives.
CONF_SPLIT_BYTES = "spark.sql.files.maxPartitionBytes"

# Settings the plans assume. AQE re-plans shuffles at runtime (partition
# coalescing, skew splits); the session time zone is pinned so no date or hour
# depends on where the driver runs.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    CONF_SPLIT_BYTES: str(16 * 1024 * 1024),
}


def build_session(master: str = "local[*]", shuffle_partitions: int = 8, app: str = "drivestats", **conf) -> SparkSession:
    """A session for tests and local runs; on a cluster use the cluster's session."""
    builder = SparkSession.builder.master(master).appName(app)
    for k, v in {**DEFAULT_CONF, "spark.sql.shuffle.partitions": str(shuffle_partitions), **conf}.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    On a cluster this is set by the cluster; it is only filled in here when
    unset (tests, local runs).
    """
    d = spark.sparkContext.getConf().get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not d:
        if not spark.sparkContext.master.startswith("local") or spark.sparkContext.master.startswith("local-cluster"):
            raise RuntimeError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        # Local runs only: all tasks run on this machine.
        d = os.path.join(tempfile.gettempdir(), "drivestats-checkpoints")
        spark.sparkContext.setCheckpointDir(d)
        d = spark.sparkContext.getCheckpointDir() or d
    return d


def work_path(spark: SparkSession, name: str) -> str:
    """A fresh location under the shared checkpoint folder for written tables."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/drivestats/{name}-{uuid.uuid4().hex[:12]}"
