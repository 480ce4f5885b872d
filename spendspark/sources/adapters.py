"""The driver tables seen as normalised transactions; rows that cannot be grouped are dropped."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from spendspark.operators.clean import groupable
from spendspark.schemas import MONEY

# Category number of each event type.
EVENT_CATEGORIES = {"click": 1, "error": 2, "purchase": 3, "signup": 4, "view": 5}


def tx_lineitem(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dense series: suppliers as users. ``transaction_id`` is not unique here."""
    return groupable(
        spark.read.parquet(f"{sf_dir}/lineitem.parquet").select(
            (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("transaction_id"),
            F.col("l_suppkey").alias("user_id"),
            F.col("l_linenumber").alias("category_id"),
            F.col("l_extendedprice").cast(MONEY).alias("amount"),
            F.to_date("l_shipdate").alias("date"),
        )
    )


def tx_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sparse series with unique keys: customers as users."""
    return groupable(
        spark.read.parquet(f"{sf_dir}/orders.parquet").select(
            F.col("o_orderkey").alias("transaction_id"),
            F.col("o_custkey").alias("user_id"),
            F.substring("o_orderpriority", 1, 1).cast("int").alias("category_id"),
            F.col("o_totalprice").cast(MONEY).alias("amount"),
            F.to_date("o_orderdate").alias("date"),
        )
    )


def tx_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Short series with times of day."""
    category = F.coalesce(
        *[F.when(F.col("event_type") == name, F.lit(n)) for name, n in EVENT_CATEGORIES.items()]
    )
    return groupable(
        spark.read.parquet(f"{sf_dir}/events.parquet").select(
            F.col("event_id").alias("transaction_id"),
            F.col("user_id"),
            category.alias("category_id"),
            F.col("value").cast(MONEY).alias("amount"),
            F.to_date("ts").alias("date"),
        )
    )
