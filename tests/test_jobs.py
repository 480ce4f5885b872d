"""Training jobs, scoring of requests, and the stream."""

import pytest
from conftest import SMALL
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from spendspark.operators import monthly, weekly
from spendspark.plans import scoring, training
from spendspark.schemas import (
    CATEGORY_FEATURES,
    CATEGORY_REQUEST,
    CATEGORY_TARGET,
    TREND_REQUEST,
    WEEKLY_REQUEST,
)
from spendspark.sources import artifacts, synthetic
from spendspark.sources.adapters import tx_lineitem, tx_orders
from spendspark.streaming import anomaly as stream


@pytest.fixture(scope="module")
def category(spark, tmp_path_factory):
    path = tmp_path_factory.mktemp("category")
    fitted = training.category_job(
        tx_lineitem(spark, SMALL), str(path / "model"), str(path / "runs"), maxIter=60, maxDepth=2
    )
    return fitted, str(path)


def test_category_job_stores_and_logs(spark, category):
    fitted, path = category
    model, features, target = artifacts.load_model(spark, f"{path}/model")
    assert (features, target) == (CATEGORY_FEATURES, CATEGORY_TARGET)
    log = {r.key: r.value for r in artifacts.read_runs(spark, f"{path}/runs").collect()}
    assert log["maxIter"] == "60" and float(log["n_rows"]) == 3584
    shares = [float(log[f"fi_{name}"]) for name in CATEGORY_FEATURES]
    assert sum(shares) == pytest.approx(1.0)
    assert [n for n, _ in fitted.evaluations] == [50]
    rows = monthly.training_rows(monthly.monthly_features(tx_lineitem(spark, SMALL)))
    repeated = training.regression_error(rows, CATEGORY_TARGET, "monthly_spending").first()
    assert 0 < fitted.metrics["mae"] < fitted.metrics["rmse"] < repeated["rmse"]


def test_category_fit_is_repeatable(spark):
    rows = monthly.training_rows(monthly.monthly_features(tx_lineitem(spark, SMALL)))
    one, two = (training.fit_category(r, maxIter=3) for r in (rows, rows.orderBy(F.rand(1)).repartition(3)))
    assert one.metrics == pytest.approx(two.metrics, rel=1e-9)


def test_category_requests(spark, category):
    fitted, _ = category
    request = {c: 1 for c in CATEGORY_FEATURES}
    rows = [
        {**request, "monthly_spending": 50_000.0},
        {**request, "monthly_spending": 0.0, "avg_monthly_spending_3m": 0.0},
        {**request, "prev_month_ratio": None},
    ]
    rows = [[float(r[f.name]) if f.dataType.typeName() == "double" and r[f.name] is not None else r[f.name] for f in CATEGORY_REQUEST] for r in rows]
    results, rejected = scoring.predict_category(spark.createDataFrame(rows, CATEGORY_REQUEST), fitted.model)
    some, none = results.orderBy(F.desc("current_spending")).collect()
    expected = (some.predicted_spending - 50_000) / 50_000 * 100
    assert some.change_percent == pytest.approx(expected, abs=0.06)
    assert (none.change_percent, none.trend) == (0.0, "stable")
    assert [r.error for r in rejected.collect()] == [scoring.MISSING_INPUT]


@pytest.mark.parametrize(
    "prediction, current, mean, expected",
    [
        (110.0, 100.0, 0.0, (110.0, "stable", 10.0)),
        (110.4, 100.0, 0.0, (110.0, "increasing", 10.4)),
        (-5.0, 100.0, 0.0, (0.0, "decreasing", -100.0)),
        (float("nan"), 100.0, 0.0, (0.0, "decreasing", -100.0)),
        (30.0, 0.0, 20.0, (30.0, "increasing", 50.0)),
        (30.0, 0.0, 0.0, (30.0, "stable", 0.0)),
    ],
)
def test_category_results(spark, prediction, current, mean, expected):
    frame = spark.createDataFrame(
        [(1, prediction, current, mean)], "category_id int, p double, monthly_spending double, avg_monthly_spending_3m double"
    )
    row = scoring.category_results(frame, "p").first()
    assert (row.predicted_spending, row.trend, row.change_percent) == expected


def test_too_few_rows(spark, tx, tmp_path):
    model, runs = str(tmp_path / "m"), str(tmp_path / "r")
    with pytest.raises(ValueError):
        training.category_job(tx((1, 1, 1, "2025-01-01")), model, runs)
    one_month = tx(*[(u, 1, 1, "2025-01-01") for u in range(100)])
    assert training.category_job(one_month, model, runs) is None
    demo = lambda: synthetic.seasonal_transactions(synthetic.demo_users(spark, 2), days=150)
    assert training.category_job(tx((1, 1, 1, "2025-01-01")), model, runs, demo, maxIter=2) is not None


@pytest.fixture(scope="module")
def weekly_model(spark, tmp_path_factory):
    path = tmp_path_factory.mktemp("weekly")
    training.sequences_job(tx_lineitem(spark, SMALL), str(path / "sequences"))
    fitted = training.weekly_job(
        spark, str(path / "sequences"), str(path / "model"), str(path / "runs"), maxIter=10
    )
    return fitted, str(path)


def test_weekly_job(spark, weekly_model):
    fitted, path = weekly_model
    model, lags, target = artifacts.load_model(spark, f"{path}/model")
    assert (lags, target) == (["lag_4", "lag_3", "lag_2", "lag_1"], "y")
    seqs, window = artifacts.read_sequences(spark, f"{path}/sequences")
    last = seqs.withColumn("last", F.col("x")[3])
    assert window == 4
    assert fitted.metrics["rmse"] < training.regression_error(last, "y", "last").first()["rmse"]
    assert 0 < model.trees <= 10


def test_weekly_job_without_sequences(spark, tx, tmp_path):
    path = str(tmp_path / "s")
    training.sequences_job(tx((1, 1, 1, "2025-01-01")), path)
    assert training.weekly_job(spark, path, str(tmp_path / "m"), str(tmp_path / "r")) is None


def test_weekly_requests(spark, weekly_model):
    fitted, _ = weekly_model
    weeks = [[1.0, 2.0, 4.0, 0.0], [0.0] * 4, [1.0] * 3, [1.0] * 5, None]
    requests = spark.createDataFrame([(w,) for w in weeks], WEEKLY_REQUEST)
    results, rejected = scoring.predict_weekly(requests, fitted.model, training.LAGS)
    assert results.count() == 2 and rejected.count() == 3
    assert {r.error for r in rejected.collect()} == {"Cần chính xác 4 tuần dữ liệu"}
    silent = results.where(F.col("input_weeks")[2] == 0).first()
    assert (silent.change_percent, silent.trend) == (0.0, "stable")


def test_weekly_scaling_and_fallback(spark):
    requests = spark.createDataFrame([([1.0, 2.0, 4.0, 0.0],), ([0.0, -1.0, 0.0, 0.0],)], WEEKLY_REQUEST)
    scaled = scoring.weekly_inputs(requests).collect()
    assert [(r.x, r.peak) for r in scaled] == [([0.25, 0.5, 1.0, 0.0], 4.0), ([0.0, -1.0, 0.0, 0.0], 1.0)]
    given = requests.withColumn("p", F.lit(3.5))
    first, second = scoring.weekly_results(given, "p").collect()
    assert (first.predicted_spending, first.change_percent, first.trend) == (4.0, 100.0, "increasing")
    assert (second.change_percent, second.trend) == (0.0, "stable")


def test_trend_requests(spark):
    rows = [(1, [100.0, 300.0], 250.0), (2, [], 5.0), (3, [0.0], 5.0), (4, None, 1.0)]
    results, rejected = scoring.analyse_trend(spark.createDataFrame(rows, TREND_REQUEST))
    first, third = results.orderBy("category_id").collect()
    assert (first.population_average, first.deviation_percent, first.status) == (200.0, 25.0, "above_average")
    assert (third.deviation_percent, third.status) == (0.0, "average")
    assert sorted(r.category_id for r in rejected.collect()) == [2, 4]


def test_missing_model_raises(spark, tmp_path):
    with pytest.raises(AnalysisException):
        artifacts.load_model(spark, str(tmp_path / "none"))


def test_stream_equals_batch(spark, tmp_path):
    folder = str(tmp_path / "in")
    tx_orders(spark, SMALL).repartition(6).write.parquet(folder)
    tx = spark.read.parquet(folder)
    model = training.fit_anomaly(tx, n_trees=20)
    batch, _ = scoring.check_transactions(tx, model.averages, model.forest)
    results = stream.score_stream(stream.read_stream(spark, folder, tx.schema, files_per_batch=2), model)
    out, checkpoint = str(tmp_path / "out"), str(tmp_path / "checkpoint")
    query = stream.write_stream(results, out, checkpoint, once=True)
    query.awaitTermination()
    assert len(query.recentProgress) >= 3
    scored = spark.read.parquet(out).select(batch.columns)
    assert scored.count() == batch.count() == 1500 and scored.exceptAll(batch).isEmpty()
    unseen = tx.limit(3).withColumn("category_id", F.lit(99))
    unseen.write.mode("append").parquet(folder)
    both = stream.score_stream(stream.read_stream(spark, folder, tx.schema), model)
    stream.write_scored(both, str(tmp_path / "both"), once=True).awaitTermination()
    passed, rejected = stream.read_scored(spark, str(tmp_path / "both"))
    assert passed.count() == 1500 and passed.select(batch.columns).exceptAll(batch).isEmpty()
    assert [(r.category_id, r.error) for r in rejected.collect()] == [(99, scoring.UNSEEN_CATEGORY)] * 3
    more = tx.limit(10).withColumn("transaction_id", F.col("transaction_id") + 1_000_000)
    more.write.mode("append").parquet(folder)
    stream.write_stream(results, out, checkpoint, once=True).awaitTermination()
    stored = spark.read.parquet(out)
    assert stored.where("error is null").count() == 1510
    assert stored.where("error is not null").count() == 3


def test_weekly_frame_feeds_the_model(spark, weekly_model):
    fitted, _ = weekly_model
    latest = weekly.latest_weeks(weekly.weekly_spend(tx_lineitem(spark, SMALL)))
    results, rejected = scoring.predict_weekly(latest, fitted.model, training.LAGS, "user_id")
    assert results.count() == 10 and rejected.isEmpty()
