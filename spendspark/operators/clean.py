"""Raw text columns to normalised transactions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from spendspark.functions.parsing import parse_amount, parse_date, parse_id, present
from spendspark.schemas import CORRUPT, TRANSACTIONS

NOT_A_RECORD = "not a record"
TOO_LARGE = "amount out of range"
NO_DATE = "no date"
NO_KEY = "neither user nor category"


def judged(raw: DataFrame, date_format: str | None = None) -> DataFrame:
    """Typed transactions with a column ``error`` that is null for usable rows."""
    corrupt = F.col(CORRUPT) if CORRUPT in raw.columns else F.lit(None).cast("string")
    return raw.select(
        parse_id(F.col("transaction_id")).alias("transaction_id"),
        parse_id(F.col("user_id")).alias("user_id"),
        parse_id(F.col("category_id")).cast("int").alias("category_id"),
        parse_amount(F.col("amount")).alias("amount"),
        parse_date(F.col("date"), date_format).alias("date"),
        present(F.col("note")).alias("note"),
        corrupt.alias(CORRUPT),
    ).withColumn(
        "error",
        F.when(F.col(CORRUPT).isNotNull(), NOT_A_RECORD)
        .when(F.col("amount").isNull(), TOO_LARGE)
        .when(F.col("date").isNull(), NO_DATE)
        .when(F.col("user_id").isNull() & F.col("category_id").isNull(), NO_KEY),
    )


def normalise(raw: DataFrame, date_format: str | None = None) -> DataFrame:
    """The usable transactions; ``rejected`` has the others.

    A transaction without a category still counts for its user's weeks and monthly totals, one
    without a user for its category's average; each path leaves out what it cannot group.
    """
    return judged(raw, date_format).where(F.col("error").isNull()).select(*TRANSACTIONS.names)


def rejected(raw: DataFrame, date_format: str | None = None) -> DataFrame:
    """The transactions that no path can use, with the reason and, for broken records, their text."""
    return judged(raw, date_format).where(F.col("error").isNotNull())


def has(*keys: str) -> Column:
    """Whether all of these columns have a value."""
    condition = F.lit(True)
    for key in keys:
        condition = condition & F.col(key).isNotNull()
    return condition


def groupable(tx: DataFrame) -> DataFrame:
    """Transactions that at least one path can use."""
    return tx.where(has("date") & (has("user_id") | has("category_id")))


def distinct_users(tx: DataFrame) -> DataFrame:
    return tx.where(has("user_id")).select("user_id").distinct()
