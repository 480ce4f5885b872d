"""Training jobs: features, split, fit, evaluation, stored model and run log."""

from __future__ import annotations

import math
import os
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import GBTRegressor
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from spendspark.operators import boosting, ensemble, iforest, monthly, regression, weekly
from spendspark.operators.anomaly import anomaly_features, category_average
from spendspark.operators.clean import has
from spendspark.operators.split import flag_ordered, hashed_split, ordered_split
from spendspark.plans.scoring import anomaly_results, with_lags
from spendspark.schemas import ANOMALY_FEATURES, CATEGORY_FEATURES, CATEGORY_TARGET, TRANSACTION_KEYS
from spendspark.session import materialise, shared_folder
from spendspark.sources import artifacts, guards

# Settings of the boosted trees; depth 5 stands for 31 leaves.
CATEGORY_PARAMS = {
    "maxIter": 200,
    "stepSize": 0.05,
    "maxDepth": 5,
    "maxBins": 255,
    "featureSubsetStrategy": "0.9",
    "subsamplingRate": 0.8,
    "seed": 42,
}
WEEKLY_PARAMS = {"maxIter": 50, "stepSize": 0.1, "maxDepth": 4, "maxBins": 255, "seed": 42}
# Fixed value: rounds without a smaller error on the tail of the training rows before a fit ends.
PATIENCE = 5
VALIDATION_TAIL = 0.1
EVALUATE_EVERY = 50
# Every task of a fit sends sums for all nodes, inputs and bins, so beyond MANY_PARTITIONS there are more only
# when these hold MOST_ROWS_PER_PARTITION rows each.
ROWS_PER_PARTITION = 50_000
MANY_PARTITIONS = 48
MOST_ROWS_PER_PARTITION = 1_000_000
LAGS = [f"lag_{n}" for n in range(weekly.WINDOW_SIZE, 0, -1)]


@dataclass
class Fitted:
    model: ensemble.Ensemble
    metrics: dict[str, float]
    params: dict = field(default_factory=dict)
    evaluations: list[tuple[int, float]] = field(default_factory=list)
    counts: dict[str, int] = field(default_factory=dict)

    def logged(self) -> dict[str, float]:
        """All numbers for the run log."""
        errors = {f"squared_error_after_{n}": error for n, error in self.evaluations}
        return {**self.metrics, **errors, **self.counts}


def regression_error(df: DataFrame, actual: str, predicted: str) -> DataFrame:
    """Root mean squared and mean absolute error, in one aggregation."""
    difference = F.col(actual) - F.col(predicted)
    return df.agg(
        F.sqrt(F.avg(difference * difference)).alias("rmse"), F.avg(F.abs(difference)).alias("mae")
    )


def importances(model: PipelineModel) -> dict[str, float]:
    """Share of the total gain per named input, in a model of ``_boosted``."""
    names = model.stages[0].getInputCols()
    return dict(zip(names, map(float, model.stages[-1].featureImportances.toArray())))


def _boosted(inputs: list[str], target: str, params: dict) -> Pipeline:
    """MLlib's trees of the same settings, with which tests compare those of ``boosting``."""
    assembler = VectorAssembler(inputCols=inputs, outputCol="features")
    trees = GBTRegressor(
        featuresCol="features", labelCol=target, maxMemoryInMB=512, **params
    )
    return Pipeline(stages=[assembler, trees])


def partitions_for(n: int) -> int:
    """By how many tasks ``n`` training rows are fitted at most."""
    return max(1, min(-(-n // ROWS_PER_PARTITION), MANY_PARTITIONS), -(-n // MOST_ROWS_PER_PARTITION))


def fit_category(rows: DataFrame, **overrides) -> Fitted:
    """Boosted trees on the monthly training rows, tested on a hashed fifth of them.

    ``rows`` should be stored: the fit and the evaluation read them separately.
    """
    shared_folder(rows.sparkSession)
    params = {**CATEGORY_PARAMS, **overrides}
    keys = ["user_id", "category_id", "year_month"]
    split = hashed_split(rows, keys)
    train, test = split.where("is_train"), split.where(~F.col("is_train"))
    fit = boosting.Boosting(train, CATEGORY_FEATURES, CATEGORY_TARGET, keys, partitions_for, params)
    fit.grow(params["maxIter"])
    fit.close()
    model = fit.ensemble()
    errors = model.prefix_errors(test, CATEGORY_TARGET)
    metrics = _metrics(errors[-1])
    metrics.update({f"fi_{name}": share for name, share in fit.importances().items()})
    metrics.update({f"splits_{name}": float(n) for name, n in model.split_counts().items()})
    evaluations = [(n, mse) for n, mse, _ in errors if n % EVALUATE_EVERY == 0]
    return Fitted(model, metrics, params, evaluations, _side_counts(split))


def _metrics(errors: tuple[int, float, float]) -> dict[str, float]:
    _, mse, mae = errors
    return {"rmse": math.nan if mse is None else math.sqrt(mse), "mae": math.nan if mae is None else mae}


def _side_counts(split: DataFrame) -> dict[str, int]:
    row = split.agg(F.count_if("is_train").alias("n_train"), F.count_if(~F.col("is_train")).alias("n_test")).first()
    return row.asDict()


def fit_weekly(seqs: DataFrame, patience: int = PATIENCE, **overrides) -> Fitted:
    """Boosted trees on four scaled weeks; the last tenth of the training rows says how many of them to keep.

    One pass gives the error of every prefix on the tail; the fit ends after ``patience`` rounds without a
    smaller one, and the best prefix is the model. Rounds are asked for in doubling numbers, and a fit goes
    on from the rounds it has. Without a tail all rounds are kept.
    ``seqs`` should be stored: the split searches it several times.
    """
    shared_folder(seqs.sparkSession)
    params = {**WEEKLY_PARAMS, **overrides}
    split = with_lags(ordered_split(seqs), LAGS)
    train, test = split.where("is_train"), split.where(~F.col("is_train"))
    tailed = flag_ordered(train, 1 - VALIDATION_TAIL, "is_fit")
    fit = boosting.Boosting(tailed.where("is_fit"), LAGS, "y", ["user_id", "target_week"], partitions_for, params)
    tail, rounds = tailed.where(~F.col("is_fit")), min(params["maxIter"], 2 * patience)
    while True:
        fit.grow(rounds)
        whole = fit.ensemble()
        errors = [mse for _, mse, _ in whole.prefix_errors(tail, "y")]
        kept, ended = ensemble.best_prefix(errors, patience)
        if ended or rounds == params["maxIter"]:
            break
        rounds = min(2 * rounds, params["maxIter"])
    fit.close()
    model = whole.first(kept)
    metrics = {**_metrics(model.prefix_errors(test, "y")[-1]), "trees_kept": float(kept)}
    return Fitted(model, metrics, params, counts=_side_counts(split))


def fit_weekly_linear(seqs: DataFrame) -> regression.Linear:
    """Least squares of the next week on the four scaled ones, over the training sequences: one aggregate."""
    train = ordered_split(seqs).where("is_train")
    return regression.fit(train, [F.col("x")[i] for i in range(weekly.WINDOW_SIZE)], F.col("y"))


def category_job(
    tx: DataFrame, model_path: str, run_log: str, demo: Callable[[], DataFrame] | None = None, **overrides
) -> Fitted | None:
    """Monthly features to a stored category model; None if too few feature rows are left."""
    spark = tx.sparkSession
    tx = guards.at_least(tx, guards.MIN_CATEGORY_TRANSACTIONS, "category forecast", demo)
    rows = materialise(monthly.training_rows(monthly.monthly_features(tx)), "monthly-rows")
    if guards.has_fewer_than(rows, guards.MIN_CATEGORY_ROWS):
        return None
    fitted = fit_category(rows, **overrides)
    artifacts.save_model(fitted.model, CATEGORY_TARGET, model_path)
    counts = {"n_transactions": tx.count(), "n_rows": rows.count()}
    artifacts.log_run(spark, run_log, artifacts.new_run_id(), fitted.params, {**fitted.logged(), **counts})
    return fitted


def sequences_job(tx: DataFrame, path: str) -> None:
    """Transactions to stored weekly sequences."""
    artifacts.write_sequences(weekly.active_sequences(weekly.weekly_spend(tx)), weekly.WINDOW_SIZE, path)


def weekly_job(
    spark: SparkSession, sequences_path: str, model_path: str, run_log: str, **overrides
) -> Fitted | None:
    """Stored sequences to a stored weekly model; None if there are no sequences."""
    seqs, window = artifacts.read_sequences(spark, sequences_path)
    if seqs.isEmpty():
        return None
    fitted = fit_weekly(seqs, **overrides)
    artifacts.save_model(fitted.model, "y", model_path)
    params = {"window_size": window, "aggregation": "weekly", **fitted.params}
    artifacts.log_run(spark, run_log, artifacts.new_run_id(), params, {**fitted.logged(), "n_sequences": seqs.count()})
    return fitted


@dataclass
class AnomalyModel:
    forest: iforest.Forest
    averages: DataFrame


def fit_anomaly(tx: DataFrame, carried: tuple[str, ...] = (), **overrides) -> AnomalyModel:
    """Category averages and a forest on the five features; ``carried`` columns stay beside the stored scores."""
    tx = tx.where(has("category_id", "date", "amount"))
    averages = materialise(category_average(tx), "category-averages")
    features = anomaly_features(tx, averages, carried)
    n = averages.agg(F.sum("transactions")).first()[0]
    keep = ("transaction_id", "amount", "amount_vs_category_avg", *carried)
    forest = iforest.fit(features, ANOMALY_FEATURES, TRANSACTION_KEYS, n=n, keep=keep, **overrides)
    return AnomalyModel(forest, averages)


def training_results(model: AnomalyModel, *carried: str) -> DataFrame:
    """Flag, score and message of the training rows, from the stored scores, and what was carried beside them."""
    return anomaly_results(model.forest.training_scores, F.col("score") - F.lit(model.forest.offset), *carried)


def training_flags(model: AnomalyModel) -> DataFrame:
    """Which training rows are anomalies, from the stored scores."""
    return model.forest.training_scores.select((F.col("score") < model.forest.offset).alias("is_anomaly"))


def anomaly_counts(results: DataFrame) -> DataFrame:
    """Number of anomalous and normal rows and the anomalous share in percent."""
    flag = F.col("is_anomaly")
    return results.agg(
        F.count_if(flag).alias("n_anomalies"),
        F.count_if(~flag).alias("n_normal"),
        (F.avg(flag.cast("int")) * 100).alias("anomaly_ratio_percent"),
    )


def save_anomaly_model(model: AnomalyModel, path: str) -> None:
    """A new version of the model; what reads the version before is not disturbed."""
    forest, spark, root = model.forest, model.averages.sparkSession, path
    path = artifacts.new_version(root)
    forest.nodes.write.parquet(os.path.join(path, "nodes"))
    model.averages.write.parquet(os.path.join(path, "averages"))
    meta = [(forest.feature_cols, forest.trees, forest.sample_size, forest.offset)]
    schema = "feature_cols array<string>, trees int, sample_size int, offset double"
    spark.createDataFrame(meta, schema).write.parquet(os.path.join(path, "meta"))
    artifacts.publish(spark, root, path)


def load_anomaly_model(spark: SparkSession, path: str) -> AnomalyModel:
    path = artifacts.current_version(spark, path)
    meta = spark.read.parquet(os.path.join(path, "meta")).first()
    nodes = spark.read.parquet(os.path.join(path, "nodes"))
    forest = iforest.Forest(
        nodes, list(meta["feature_cols"]), meta["trees"], meta["sample_size"], meta["offset"]
    )
    return AnomalyModel(forest, spark.read.parquet(os.path.join(path, "averages")))


def anomaly_job(
    tx: DataFrame, model_path: str, run_log: str, demo: Callable[[], DataFrame] | None = None, **overrides
) -> AnomalyModel:
    """Transactions to a stored anomaly model, with its share of anomalies logged."""
    spark = tx.sparkSession
    tx = guards.at_least(tx, guards.MIN_ANOMALY_TRANSACTIONS, "anomaly detection", demo)
    model = fit_anomaly(tx, **overrides)
    save_anomaly_model(model, model_path)
    metrics = anomaly_counts(training_flags(model)).first().asDict()
    params = {
        "contamination": iforest.CONTAMINATION,
        "n_estimators": model.forest.trees,
        "n_samples": metrics["n_anomalies"] + metrics["n_normal"],
    }
    artifacts.log_run(spark, run_log, artifacts.new_run_id(), {**params, **overrides}, metrics)
    return model
