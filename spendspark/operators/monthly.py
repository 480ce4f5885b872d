"""Monthly features per user and category.

The first aggregation turns transactions into one row per user, category and month before
anything is shuffled by user. From then on a user has at most (categories x months) rows, so
all windows can share one partitioning by user without a hot task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql.window import WindowSpec

from spendspark.functions.calendar import day_of_month, day_of_week, month_start
from spendspark.functions.numeric import clip, safe_ratio
from spendspark.operators.clean import has
from spendspark.schemas import CATEGORY_FEATURES, CATEGORY_TARGET

TREND_CAP = 5.0


def _history() -> WindowSpec:
    return W.partitionBy("user_id", "category_id").orderBy("year_month")


def monthly_spending(tx: DataFrame) -> DataFrame:
    """Sum, count, mean, maximum of amount and mean day numbers per user, category and month.

    Transactions without a category have a row of their own: they count in the user's total.
    """
    n = F.count("amount")
    return (
        tx.where(has("user_id", "date"))
        .select(
            "user_id",
            "category_id",
            month_start(F.col("date")).alias("year_month"),
            "amount",
            day_of_week(F.col("date")).alias("dow"),
            day_of_month(F.col("date")).alias("dom"),
        )
        .groupBy("user_id", "category_id", "year_month")
        .agg(
            F.sum("amount").alias("spending"),
            n.cast("int").alias("transaction_count"),
            (F.sum("amount").cast("double") / n).alias("avg_transaction"),
            F.max("amount").cast("double").alias("max_transaction"),
            (F.sum("dow") / F.count("dow")).alias("avg_day_of_week"),
            (F.sum("dom") / F.count("dom")).alias("avg_day_of_month"),
        )
    )


def monthly_category(tx: DataFrame) -> DataFrame:
    """The rows of ``monthly_spending`` that have a category."""
    return monthly_spending(tx).where(has("category_id"))


def as_money_totals(monthly: DataFrame) -> DataFrame:
    """The exact decimal sums as the floating-point feature."""
    return monthly.withColumn("monthly_spending", F.col("spending").cast("double")).drop("spending")


def user_month_total(monthly: DataFrame) -> DataFrame:
    """Total of all categories, from the category rows and not from the transactions again."""
    return monthly.groupBy("user_id", "year_month").agg(
        F.sum("spending").cast("double").alias("total_all_categories")
    )


def with_ratio(monthly: DataFrame) -> DataFrame:
    """Adds the user's total of the month and the category's share of it.

    Rows without a category count in the total and then go.

    The repartition is the one exchange by user that this and the history windows share.
    """
    totals = F.sum("spending").over(W.partitionBy("user_id", "year_month")).cast("double")
    return (
        monthly.repartition("user_id")
        .withColumn("total_all_categories", totals)
        .where(has("category_id"))
        .transform(as_money_totals)
        .withColumn("category_ratio", safe_ratio(F.col("monthly_spending"), F.col("total_all_categories")))
    )


def _lagged(name: str) -> Column:
    return F.lag(name).over(_history())


def with_history(shares: DataFrame) -> DataFrame:
    """Previous active month, mean of up to three of them, trend, and the next one as target.

    "Previous" counts rows: a month without transactions is skipped, not filled.
    """
    before = F.avg("monthly_spending").over(_history().rowsBetween(-3, -1))
    return (
        shares.withColumns(
            {
                "prev_month_spending": _lagged("monthly_spending"),
                "prev_month_count": _lagged("transaction_count").cast("double"),
                "prev_month_ratio": _lagged("category_ratio"),
                "avg_monthly_spending_3m": before,
                CATEGORY_TARGET: F.lead("monthly_spending").over(_history()),
            }
        )
        .withColumns(
            {
                "spending_trend": clip(
                    safe_ratio(F.col("prev_month_spending"), F.col("avg_monthly_spending_3m")), 0.0, TREND_CAP
                ),
                "month": F.month("year_month"),
                "year": F.year("year_month"),
            }
        )
    )


def monthly_features(tx: DataFrame) -> DataFrame:
    """All months with all 16 features and the target, complete or not."""
    return (
        with_history(with_ratio(monthly_spending(tx)))
        .select("user_id", "year_month", *CATEGORY_FEATURES, CATEGORY_TARGET)
    )


def training_rows(features: DataFrame) -> DataFrame:
    """Months with a previous and a next active month."""
    return features.dropna(subset=["prev_month_spending", CATEGORY_TARGET, "avg_monthly_spending_3m"])


def scoring_rows(features: DataFrame) -> DataFrame:
    """The latest month of each user and category; its lags may be missing."""
    return features.where(F.col(CATEGORY_TARGET).isNull()).drop(CATEGORY_TARGET)
