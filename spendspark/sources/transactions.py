"""Transactions from CSV or JSON files, and versioned snapshots of them."""

from __future__ import annotations

import os
import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from spendspark.schemas import CORRUPT, RAW_COLUMNS, RAW_TRANSACTIONS

_REQUIRED = {"user_id", "category_id", "amount", "date"}


def read_csv(spark: SparkSession, path: str, multiline: bool = False) -> DataFrame:
    """Raw text columns of a CSV file or folder, with or without a header line.

    The header is recognised by a ``date`` (or ``transaction_date``) column. With a header the
    columns are taken by name, whatever their order; without one the six fixed names apply. All files
    of a folder must have the same header, or none: Spark raises when it meets another one.
    ``multiline`` allows line breaks inside quoted notes, at the price of unsplittable files.
    """
    reader = spark.read.option("escape", '"').option("multiLine", multiline)
    headed = reader.option("header", True).option("enforceSchema", False).csv(path)
    if {"date", "transaction_date"} & set(headed.columns):
        return by_name(headed)
    return reader.option("header", False).schema(RAW_TRANSACTIONS).csv(path)


def read_json(spark: SparkSession, path: str, multiline: bool = False) -> DataFrame:
    """Raw text columns of landed JSON records: one per line, or lists of records.

    ``transaction_date`` also counts as ``date``. A line that is no record keeps its text in a column
    of its own, so that it can be rejected rather than vanish.
    """
    schema = T.StructType([*RAW_TRANSACTIONS, T.StructField("transaction_date", T.StringType()), T.StructField(CORRUPT, T.StringType())])
    reader = spark.read.schema(schema).option("multiLine", multiline).option("columnNameOfCorruptRecord", CORRUPT)
    dated = reader.json(path).withColumn("date", F.coalesce("date", "transaction_date"))
    return dated.select(*RAW_COLUMNS, CORRUPT)


def by_name(df: DataFrame) -> DataFrame:
    """The six raw columns, by name; a missing id or note becomes null."""
    if "date" not in df.columns and "transaction_date" in df.columns:
        df = df.withColumnRenamed("transaction_date", "date")
    missing = _REQUIRED - set(df.columns)
    if missing:
        raise ValueError(f"transactions lack the columns {sorted(missing)}")
    return df.select(
        *[
            (F.col(c) if c in df.columns else F.lit(None)).cast("string").alias(c)
            for c in RAW_COLUMNS
        ]
    )


def publish_snapshot(df: DataFrame, root: str) -> str | None:
    """Write a new snapshot version, unless the batch is empty; returns the current version.

    Each version gets a folder of its own and a pointer row after its data is complete, so a
    reader never sees a half-written or overwritten snapshot.
    """
    spark = df.sparkSession
    if df.isEmpty():
        return current_snapshot(spark, root)
    version = os.path.join(root, "versions", uuid.uuid4().hex)
    df.write.parquet(version)
    pointer = spark.range(1).select(F.lit(version).alias("path"), F.current_timestamp().alias("published"))
    pointer.write.mode("append").parquet(os.path.join(root, "pointer"))
    return version


def current_snapshot(spark: SparkSession, root: str) -> str | None:
    """Path of the latest complete snapshot, or None if nothing was published yet."""
    try:
        pointers = spark.read.parquet(os.path.join(root, "pointer"))
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        return None
    return pointers.agg(F.max_by("path", "published")).first()[0]


def read_snapshot(spark: SparkSession, root: str) -> DataFrame:
    path = current_snapshot(spark, root)
    if path is None:
        raise FileNotFoundError(f"no snapshot published under {root}")
    return spark.read.parquet(path)
