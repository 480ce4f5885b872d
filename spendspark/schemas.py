"""Column names and types of the tables the jobs read and write."""

from __future__ import annotations

from pyspark.sql import types as T

# Names and order of a headerless transactions file.
RAW_COLUMNS = ["transaction_id", "user_id", "category_id", "amount", "date", "note"]

# Where a JSON reader puts the text of a line that is no record.
CORRUPT = "corrupt_record"

RAW_TRANSACTIONS = T.StructType([T.StructField(c, T.StringType()) for c in RAW_COLUMNS])

MONEY = T.DecimalType(24, 6)

TRANSACTIONS = T.StructType(
    [
        T.StructField("transaction_id", T.LongType()),
        T.StructField("user_id", T.LongType()),
        T.StructField("category_id", T.IntegerType()),
        T.StructField("amount", MONEY),
        T.StructField("date", T.DateType()),
        T.StructField("note", T.StringType()),
    ]
)

# Model inputs in the order the models are trained with.
CATEGORY_FEATURES = [
    "category_id",
    "month",
    "year",
    "monthly_spending",
    "transaction_count",
    "avg_transaction",
    "max_transaction",
    "avg_day_of_week",
    "avg_day_of_month",
    "total_all_categories",
    "category_ratio",
    "prev_month_spending",
    "prev_month_count",
    "prev_month_ratio",
    "avg_monthly_spending_3m",
    "spending_trend",
]
CATEGORY_TARGET = "next_month_spending"
ANOMALY_FEATURES = ["amount", "category_id", "day_of_week", "day_of_month", "amount_vs_category_avg"]

# What tells transactions apart when a forest draws its samples, even if ids repeat.
TRANSACTION_KEYS = ["transaction_id", "user_id", "category_id", "amount", "date"]

_INTEGER_INPUTS = {"category_id", "month", "year", "transaction_count"}

CATEGORY_REQUEST = T.StructType(
    [
        T.StructField(c, T.IntegerType() if c in _INTEGER_INPUTS else T.DoubleType())
        for c in CATEGORY_FEATURES
    ]
)
TREND_REQUEST = T.StructType(
    [
        T.StructField("category_id", T.IntegerType()),
        T.StructField("monthly_averages", T.ArrayType(T.DoubleType())),
        T.StructField("user_current_spending", T.DoubleType()),
    ]
)
ANOMALY_REQUEST = T.StructType(
    [
        T.StructField("transaction_id", T.LongType()),
        T.StructField("amount", T.DoubleType()),
        T.StructField("category_id", T.IntegerType()),
        T.StructField("day_of_week", T.IntegerType()),
        T.StructField("day_of_month", T.IntegerType()),
        T.StructField("amount_vs_category_avg", T.DoubleType()),
    ]
)
WEEKLY_REQUEST = T.StructType([T.StructField("weekly_spending", T.ArrayType(T.DoubleType()))])

RUN_LOG = T.StructType(
    [
        T.StructField("run_id", T.StringType()),
        T.StructField("kind", T.StringType()),
        T.StructField("key", T.StringType()),
        T.StructField("value", T.StringType()),
        T.StructField("ts", T.TimestampType()),
    ]
)

FOREST_NODES = T.StructType(
    [
        T.StructField("tree", T.IntegerType()),
        T.StructField("slot", T.IntegerType()),
        T.StructField("feature", T.IntegerType()),
        T.StructField("threshold", T.DoubleType()),
        T.StructField("path_length", T.DoubleType()),
    ]
)
