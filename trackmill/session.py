"""Session settings and the shared folder used for checkpoints and scratch tables."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# What the library wants of a session.  Partition counts are left to the cluster, since a
# number fixed here would only be right for one data size: adaptive execution coalesces but
# never adds partitions, so set ``spark.sql.adaptive.coalescePartitions.initialPartitionNum``
# (or ``spark.sql.shuffle.partitions``) to suit the largest shuffle, about 128 MB to each.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.parquet.filterPushdown": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def build_session(app_name: str = "trackmill", master: str | None = None, **extra: str) -> SparkSession:
    """Session with the library's settings; ``extra`` uses ``__`` for dots."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in SETTINGS.items():
        builder = builder.config(key, value)
    for key, value in extra.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def shared_root(spark: SparkSession) -> str:
    """Folder every executor can reach, as the session names it.

    A temporary folder stands in only for a local master, where the driver and the
    executors are one machine.
    """
    context = spark.sparkContext
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        if context.getCheckpointDir() is None:
            context.setCheckpointDir(configured)
        return configured.rstrip("/")
    if context.getCheckpointDir():
        return context.getCheckpointDir().rstrip("/")
    if not context.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by the cluster")
    root = tempfile.mkdtemp(prefix="trackmill-")
    context.setCheckpointDir(root)
    return root


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path for a written table, under the shared folder."""
    return f"{shared_root(spark)}/scratch/{label}-{uuid.uuid4().hex}"


def durable(df: DataFrame) -> DataFrame:
    """``df`` with its lineage cut by a reliable checkpoint, so that partition
    numbers and row order inside partitions stay fixed if an executor is lost."""
    shared_root(df.sparkSession)
    return df.checkpoint(eager=True)
