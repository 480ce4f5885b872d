"""Anomaly check on a stream of transactions."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from spendspark.plans.scoring import judged_transactions
from spendspark.plans.training import AnomalyModel


def read_stream(
    spark: SparkSession, folder: str, schema: StructType, files_per_batch: int = 1000
) -> DataFrame:
    """New Parquet files of a folder, as they arrive, a bounded number at a time."""
    reader = spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch)
    return reader.parquet(folder)


def score_stream(tx: DataFrame, model: AnomalyModel) -> DataFrame:
    """The batch plan on a stream: a stream-static join and a column function, no state.

    One row per transaction, with its result or its error, so that the stream is read once.
    """
    return judged_transactions(tx, model.averages, model.forest)


def write_stream(df: DataFrame, path: str, checkpoint: str, once: bool = False, by: tuple[str, ...] = ()) -> StreamingQuery:
    """Append rows as files, each exactly once; ``once`` stops after the files present now."""
    writer = df.writeStream.format("parquet").outputMode("append").option("checkpointLocation", checkpoint).partitionBy(*by)
    return (writer.trigger(availableNow=True) if once else writer).start(path)


def write_scored(scored: DataFrame, out: str, once: bool = False) -> StreamingQuery:
    """One query for both outcomes, which get a folder each below ``out/transactions``."""
    outcome = F.when(F.col("error").isNull(), "results").otherwise("rejected")
    folders = [os.path.join(out, name) for name in ("transactions", "checkpoint")]
    return write_stream(scored.withColumn("outcome", outcome), *folders, once, ("outcome",))


def read_scored(spark: SparkSession, out: str) -> tuple[DataFrame, DataFrame]:
    """Results and rejected transactions of a stream so far."""
    stored = spark.read.parquet(os.path.join(out, "transactions"))
    results, rejected = (stored.where(F.col("outcome") == name).drop("outcome") for name in ("results", "rejected"))
    return results.drop("error"), rejected.drop("is_anomaly", "anomaly_score", "message")
