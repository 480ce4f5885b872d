"""Requests and predictions to results: pure column work, the same for batches and streams."""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from spendspark.functions import labels, numeric
from spendspark.operators.anomaly import anomaly_features
from spendspark.operators.ensemble import Ensemble
from spendspark.operators.iforest import Forest
from spendspark.operators.regression import Linear
from spendspark.schemas import ANOMALY_FEATURES, CATEGORY_FEATURES

UNSEEN_CATEGORY = "no stored average for this category"
MISSING_INPUT = "a model input is missing"


def accepted_and_rejected(requests: DataFrame, error: Column) -> tuple[DataFrame, DataFrame]:
    """Split on a column expression that is null for a good request and an error text otherwise."""
    checked = requests.withColumn("error", error)
    return checked.where(F.col("error").isNull()).drop("error"), checked.where(F.col("error").isNotNull())


def _has_gap(array: str) -> Column:
    return F.exists(array, lambda v: v.isNull() | F.isnan(v))


def weekly_request_error() -> Column:
    values = F.coalesce(F.size("weekly_spending"), F.lit(0))
    return F.when(values != 4, labels.NEEDS_FOUR_WEEKS).when(_has_gap("weekly_spending"), MISSING_INPUT)


def trend_request_error() -> Column:
    values = F.coalesce(F.size("monthly_averages"), F.lit(0))
    missing = _has_gap("monthly_averages") | F.col("category_id").isNull() | F.col("user_current_spending").isNull()
    return F.when(values < 1, labels.NEEDS_AVERAGES).when(missing, MISSING_INPUT)


def missing_input_error(inputs: list[str]) -> Column:
    return F.when(reduce(or_, [F.col(name).isNull() for name in inputs]), MISSING_INPUT)


# ---- category forecast ---------------------------------------------------------------------


def category_results(df: DataFrame, prediction: str, *keys: str) -> DataFrame:
    """Forecast against the month just ended, or the three-month mean if that month is empty."""
    predicted = numeric.floor_at_zero(F.col(prediction))
    current = F.col("monthly_spending")
    return (
        df.withColumn("_predicted", predicted)
        .withColumn(
            "_change",
            numeric.percent_change_or(F.col("_predicted"), current, F.col("avg_monthly_spending_3m")),
        )
        .select(
            *keys,
            "category_id",
            numeric.money_round(F.col("_predicted")).alias("predicted_spending"),
            current.alias("current_spending"),
            labels.trend_label(F.col("_change")).alias("trend"),
            numeric.percent_round(F.col("_change")).alias("change_percent"),
        )
    )


def predict_category(requests: DataFrame, model: Ensemble, *keys: str) -> tuple[DataFrame, DataFrame]:
    """Results and rejected requests; other columns than the inputs must be in ``keys``."""
    inputs = requests.select(*keys, *[F.col(c) for c in CATEGORY_FEATURES if c not in keys])
    good, rejected = accepted_and_rejected(inputs, missing_input_error(CATEGORY_FEATURES))
    return category_results(model.transform(good), "prediction", *keys), rejected


# ---- population trend ----------------------------------------------------------------------


def deviation_results(df: DataFrame, *keys: str) -> DataFrame:
    """``population_mean`` against ``user_current_spending``."""
    mean, user = F.col("population_mean"), F.col("user_current_spending")
    deviation = F.when(mean > 0, numeric.percent_change(user, mean)).otherwise(0.0)
    return df.withColumn("_deviation", deviation).select(
        *keys,
        "category_id",
        numeric.money_round(mean).alias("population_average"),
        user.alias("user_spending"),
        numeric.percent_round(F.col("_deviation")).alias("deviation_percent"),
        labels.deviation_label(F.col("_deviation")).alias("status"),
        labels.deviation_message(F.col("_deviation")).alias("message"),
    )


def analyse_trend(requests: DataFrame, *keys: str) -> tuple[DataFrame, DataFrame]:
    """Results and rejected requests, for requests that carry their averages as an array."""
    good, rejected = accepted_and_rejected(requests, trend_request_error())
    means = good.withColumn("population_mean", numeric.array_mean(F.col("monthly_averages")))
    return deviation_results(means, *keys), rejected


# ---- anomaly check -------------------------------------------------------------------------


def anomaly_results(df: DataFrame, decision: Column, *more: str) -> DataFrame:
    """Flag, rounded score and message; a negative decision value means an anomaly."""
    is_anomaly = F.col("_decision") < 0
    return df.withColumn("_decision", decision).select(
        "transaction_id",
        *more,
        is_anomaly.alias("is_anomaly"),
        numeric.score_round(F.col("_decision")).alias("anomaly_score"),
        labels.anomaly_message(is_anomaly, F.col("amount"), F.col("amount_vs_category_avg")).alias("message"),
    )


def _scored(features: DataFrame, forest: Forest) -> DataFrame:
    return anomaly_results(features.select("transaction_id", *ANOMALY_FEATURES), forest.decision())


def check_requests(requests: DataFrame, forest: Forest) -> tuple[DataFrame, DataFrame]:
    """Results and rejected requests, for requests that bring their features with them."""
    good, rejected = accepted_and_rejected(requests, missing_input_error(ANOMALY_FEATURES))
    return _scored(good, forest), rejected


def check_transactions(tx: DataFrame, averages: DataFrame, forest: Forest) -> tuple[DataFrame, DataFrame]:
    """Results, and the transactions with missing inputs or of categories the model has not seen."""
    known, rejected = accepted_and_rejected(anomaly_features(tx, averages), _transaction_error())
    return _scored(known, forest), rejected


def _transaction_error() -> Column:
    missing = missing_input_error([name for name in ANOMALY_FEATURES if name != "amount_vs_category_avg"])
    return F.coalesce(missing, F.when(F.col("category_avg").isNull(), UNSEEN_CATEGORY))


def judged_transactions(tx: DataFrame, averages: DataFrame, forest: Forest) -> DataFrame:
    """What ``check_transactions`` tells apart, in one table: each transaction with its result or its error."""
    features = anomaly_features(tx, averages).withColumn("error", _transaction_error())
    decision = F.when(F.col("error").isNull(), forest.decision())
    return anomaly_results(features, decision, "user_id", "category_id", "amount", "date", "error")


# ---- weekly forecast -----------------------------------------------------------------------


def weekly_inputs(requests: DataFrame) -> DataFrame:
    """Four weeks scaled by their own peak: not the scaling used in training, as specified."""
    weeks = F.col("weekly_spending")
    return requests.withColumns({"x": numeric.scale_by_peak(weeks), "peak": numeric.peak_or_one(weeks)})


def weekly_results(df: DataFrame, predicted: str, *keys: str) -> DataFrame:
    """Forecast in money against the last week, or the mean of the four if that week is empty."""
    weeks = F.col("weekly_spending")
    floored = numeric.floor_at_zero(F.col(predicted))
    last, mean = F.element_at(weeks, -1), numeric.array_mean(weeks)
    change = numeric.percent_change_or(F.col("_predicted"), last, mean)
    return (
        df.withColumn("_predicted", floored)
        .withColumn("_change", change)
        .select(
            *keys,
            numeric.money_round(F.col("_predicted")).alias("predicted_spending"),
            weeks.alias("input_weeks"),
            labels.trend_label(F.col("_change")).alias("trend"),
            numeric.percent_round(F.col("_change")).alias("change_percent"),
        )
    )


def with_lags(df: DataFrame, lags: list[str]) -> DataFrame:
    """The elements of ``x`` as the named model inputs."""
    return df.withColumns({name: F.col("x")[i] for i, name in enumerate(lags)})


def predict_weekly_linear(requests: DataFrame, model: Linear, *keys: str) -> tuple[DataFrame, DataFrame]:
    """Results and rejected requests of the linear forecast."""
    good, rejected = accepted_and_rejected(requests, weekly_request_error())
    lags = [F.col("x")[i] for i in range(len(model.weights))]
    money = weekly_inputs(good).withColumn("_money", model.predict(lags) * F.col("peak"))
    return weekly_results(money, "_money", *keys), rejected


def predict_weekly(
    requests: DataFrame, model: Ensemble, lags: list[str], *keys: str
) -> tuple[DataFrame, DataFrame]:
    """Results and rejected requests."""
    good, rejected = accepted_and_rejected(requests, weekly_request_error())
    scaled = with_lags(weekly_inputs(good), lags)
    money = model.transform(scaled).withColumn("_money", F.col("prediction") * F.col("peak"))
    return weekly_results(money, "_money", *keys), rejected
