"""Stored sequences, model bundles and the run log."""

from __future__ import annotations

import os
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from spendspark.operators.ensemble import NODES, Ensemble
from spendspark.schemas import RUN_LOG


def write_sequences(sequences: DataFrame, window: int, path: str) -> None:
    """Sequences (possibly none) with the window size they were cut with."""
    sequences.write.mode("errorifexists").parquet(os.path.join(path, "sequences"))
    meta = sequences.sparkSession.range(1).select(F.lit(window).alias("window_size"))
    meta.write.mode("errorifexists").parquet(os.path.join(path, "meta"))


def read_sequences(spark: SparkSession, path: str) -> tuple[DataFrame, int]:
    window = spark.read.parquet(os.path.join(path, "meta")).first()["window_size"]
    return spark.read.parquet(os.path.join(path, "sequences")), window


def new_version(root: str) -> str:
    return os.path.join(root, "versions", uuid.uuid4().hex)


def publish(spark: SparkSession, root: str, version: str) -> None:
    """Make a completely written version the current one."""
    pointer = spark.range(1).select(F.lit(version).alias("path"), F.current_timestamp().alias("published"))
    pointer.write.mode("append").parquet(os.path.join(root, "pointer"))


def current_version(spark: SparkSession, root: str) -> str:
    """Path of the latest complete version; a missing root raises Spark's own error."""
    return spark.read.parquet(os.path.join(root, "pointer")).agg(F.max_by("path", "published")).first()[0]


def save_model(model: Ensemble, target_col: str, path: str) -> None:
    """A node table and its ordered inputs, as a new version below ``path``."""
    spark, version = model.nodes.sparkSession, new_version(path)
    model.nodes.write.parquet(os.path.join(version, "nodes"))
    meta = spark.createDataFrame([(model.inputs, target_col)], "feature_cols array<string>, target_col string")
    meta.write.parquet(os.path.join(version, "meta"))
    publish(spark, path, version)


def load_model(spark: SparkSession, path: str) -> tuple[Ensemble, list[str], str]:
    """The current version. A missing path raises Spark's own error: there is nothing to score with."""
    path = current_version(spark, path)
    meta = spark.read.parquet(os.path.join(path, "meta")).first()
    nodes = spark.read.schema(NODES).parquet(os.path.join(path, "nodes"))
    return Ensemble(nodes, list(meta["feature_cols"])), list(meta["feature_cols"]), meta["target_col"]


def new_run_id() -> str:
    return uuid.uuid4().hex


def log_run(spark: SparkSession, path: str, run_id: str, params: dict, metrics: dict) -> None:
    """Append one row per parameter and metric of a run."""
    rows = [(run_id, "param", k, str(v)) for k, v in params.items()]
    rows += [(run_id, "metric", k, repr(float(v))) for k, v in metrics.items()]
    entries = spark.createDataFrame(rows, "run_id string, kind string, key string, value string")
    entries = entries.withColumn("ts", F.current_timestamp()).select(*RUN_LOG.names)
    entries.coalesce(1).write.mode("append").parquet(path)


def read_runs(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(RUN_LOG).parquet(path)
