"""The whole way from landed files to results, through the command line."""

import json

import pytest
from conftest import SMALL

from spendspark.__main__ import main
from spendspark.schemas import CATEGORY_FEATURES
from spendspark.sources.adapters import tx_lineitem
from spendspark.streaming import anomaly as stream


@pytest.fixture(scope="module")
def folders(spark, tmp_path_factory):
    """Landed CSV, an ingested snapshot, and the three trained models."""
    root = tmp_path_factory.mktemp("jobs")
    tx_lineitem(spark, SMALL).write.option("header", True).csv(str(root / "landing"))
    path = {name: str(root / name) for name in ("snapshot", "seqs", "weekly", "category", "anomaly", "runs")}
    main(["ingest", "--input", str(root / "landing"), "--out", path["snapshot"]])
    source = ["--input", path["snapshot"], "--format", "snapshot"]
    main(["sequences", *source, "--out", path["seqs"]])
    log = ["--runs", path["runs"], "--rounds", "3"]
    main(["train-weekly", "--input", path["seqs"], "--out", path["weekly"], *log])
    main(["train-category", *source, "--out", path["category"], *log])
    main(["train-anomaly", *source, "--out", path["anomaly"], *log[:2]])
    return path


def results(spark, out):
    return spark.read.parquet(f"{out}/results"), spark.read.parquet(f"{out}/rejected")


def test_every_training_job_logged_a_run(spark, folders):
    assert spark.read.parquet(folders["runs"]).select("run_id").distinct().count() == 3


@pytest.mark.parametrize(
    "job, model, good", [("predict-category", "category", 70), ("predict-weekly", "weekly", 10), ("check-anomalies", "anomaly", 6000)]
)
def test_scoring_transactions(spark, folders, tmp_path, job, model, good):
    out = str(tmp_path / "out")
    main([job, "--input", folders["snapshot"], "--format", "snapshot", "--transactions", "--model", folders[model], "--out", out])
    scored, rejected = results(spark, out)
    assert (scored.count(), rejected.count()) == (good, 0)


@pytest.mark.parametrize(
    "job, model, good, bad",
    [
        ("predict-category", "category", {c: 1 for c in CATEGORY_FEATURES}, {"category_id": 1}),
        ("predict-weekly", "weekly", {"weekly_spending": [1, 2, 3, 4]}, {"weekly_spending": [1]}),
        (
            "analyse-trend", None,
            {"category_id": 1, "monthly_averages": [5], "user_current_spending": 7},
            {"category_id": 1, "monthly_averages": [], "user_current_spending": 7},
        ),
        (
            "check-anomalies", "anomaly",
            {"transaction_id": 1, "amount": 9e9, "category_id": 1, "day_of_week": 1, "day_of_month": 1, "amount_vs_category_avg": 900},
            {"transaction_id": 2},
        ),
    ],
)
def test_scoring_requests(spark, folders, tmp_path, job, model, good, bad):
    (tmp_path / "requests.json").write_text(json.dumps(good) + "\n" + json.dumps(bad) + "\n")
    options = ["--model", folders[model]] if model else []
    main([job, "--input", str(tmp_path / "requests.json"), "--out", str(tmp_path / "out"), *options])
    scored, rejected = results(spark, tmp_path / "out")
    assert (scored.count(), rejected.count()) == (1, 1)


def test_streaming_job(spark, folders, tmp_path):
    snapshot = tx_lineitem(spark, SMALL).selectExpr("*", "cast(null as string) as note")
    snapshot.repartition(3).write.parquet(str(tmp_path / "in"))
    main(["stream-anomalies", "--input", str(tmp_path / "in"), "--model", folders["anomaly"], "--out", str(tmp_path / "out"), "--once"])
    scored, rejected = stream.read_scored(spark, str(tmp_path / "out"))
    assert (scored.count(), rejected.count()) == (6000, 0)


@pytest.mark.parametrize("given", [["--transactions"], ["--demo"], ["--date-format", "yyyy/MM/dd"], ["--model", "m"]])
def test_options_that_a_job_does_not_use_are_refused(given):
    with pytest.raises(SystemExit):
        main(["train-weekly", "--input", "in", "--out", "out", *given])


def test_requests_take_no_options_of_transactions():
    with pytest.raises(SystemExit):
        main(["check-anomalies", "--input", "in", "--out", "out", "--model", "m", "--format", "snapshot"])
    with pytest.raises(SystemExit):
        main(["check-anomalies", "--input", "in", "--out", "out"])
