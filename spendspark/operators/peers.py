"""A user's spending in a category against that of everyone else."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spendspark.operators.lookup import left_lookup
from spendspark.session import materialise


def latest_and_totals(monthly: DataFrame) -> DataFrame:
    """Per user and category: the latest month's spending, and what the mean needs."""
    return monthly.groupBy("user_id", "category_id").agg(
        F.max_by("spending", "year_month").cast("double").alias("user_current_spending"),
        F.sum("spending").alias("spending"),
        F.count("spending").alias("months"),
    )


def population_mean(totals: DataFrame) -> DataFrame:
    """Mean over all user-months of a category."""
    return totals.groupBy("category_id").agg(
        (F.sum("spending").cast("double") / F.sum("months")).alias("population_mean")
    )


def with_population_mean(monthly: DataFrame) -> DataFrame:
    """Latest spending beside the category's mean; the transactions are read once."""
    totals = materialise(latest_and_totals(monthly), "peer-totals")
    means = materialise(population_mean(totals), "peer-means")
    users = totals.select("user_id", "category_id", "user_current_spending")
    return left_lookup(users, means, "category_id", spread_by=["user_id"])
