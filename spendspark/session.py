"""Session settings and the shared folder for materialised intermediates."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def build_session(app_name: str = "spendspark", master: str | None = None, **extra: str) -> SparkSession:
    """A session with the settings every job here relies on.

    Shuffle partitions are left to the caller or the cluster; AQE coalesces small ones and
    splits skewed join partitions.
    """
    builder = (
        SparkSession.builder.appName(app_name)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    if master:
        builder = builder.master(master)
    for key, value in extra.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can reach: ``spark.checkpoint.dir`` of the session.

    Only a local-mode session without that setting gets a folder of its own; on a cluster a
    machine-local folder would lose data with the machine, so there the setting is required.
    """
    sc = spark.sparkContext
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if configured is None:
        if not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
        configured = tempfile.mkdtemp(prefix="spendspark-")
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(configured)
    return configured


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh, never reused path below the shared folder."""
    return os.path.join(shared_folder(spark), "spendspark", f"{label}-{uuid.uuid4().hex}")


def materialise(df: DataFrame, label: str) -> DataFrame:
    """Compute ``df`` once into the shared folder and read it back.

    Parquet rather than ``checkpoint()``: later passes keep column pruning and predicate
    pushdown, and the files survive the loss of any executor.
    """
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
