"""The jobs from the command line: ``spark-submit ... -m spendspark <job>`` or ``python -m spendspark``.

Training jobs read transactions and store a model and run-log rows. Scoring jobs read requests
and write ``results`` and ``rejected`` folders. Paths may be on any file system Spark knows.
"""

from __future__ import annotations

import argparse
import os

from pyspark.sql import DataFrame, SparkSession

from spendspark import schemas
from spendspark.operators import monthly, peers, weekly
from spendspark.operators.clean import normalise
from spendspark.plans import ingest, scoring, training
from spendspark.session import build_session, materialise
from spendspark.sources import artifacts, synthetic, transactions
from spendspark.streaming import anomaly as stream


def load_transactions(spark: SparkSession, args: argparse.Namespace) -> DataFrame:
    """Normalised transactions from a published snapshot root, or from CSV or JSON records.

    Jobs read them several times, so text is parsed once and stored.
    """
    if args.format == "snapshot":
        return transactions.read_snapshot(spark, args.input)
    return materialise(normalise(read_raw(spark, args), args.date_format), "transactions")


def read_raw(spark: SparkSession, args: argparse.Namespace) -> DataFrame:
    read = transactions.read_csv if args.format == "csv" else transactions.read_json
    return read(spark, args.input, args.multiline)


def write_both(results: DataFrame, rejected: DataFrame, out: str) -> None:
    results.write.parquet(os.path.join(out, "results"))
    rejected.write.parquet(os.path.join(out, "rejected"))


def run_ingest(spark: SparkSession, args: argparse.Namespace) -> None:
    demo = (lambda: synthetic.tiny_transactions(synthetic.demo_users(spark, 2, 101))) if args.demo else None
    ingest.ingest_job(spark, lambda: read_raw(spark, args), args.out, demo, args.date_format)


def run_train_category(spark: SparkSession, args: argparse.Namespace) -> None:
    demo = (lambda: synthetic.seasonal_transactions(synthetic.demo_users(spark, 5))) if args.demo else None
    tx = load_transactions(spark, args)
    training.category_job(tx, args.out, args.runs, demo, **rounds(args))


def run_sequences(spark: SparkSession, args: argparse.Namespace) -> None:
    training.sequences_job(load_transactions(spark, args), args.out)


def run_train_weekly(spark: SparkSession, args: argparse.Namespace) -> None:
    training.weekly_job(spark, args.input, args.out, args.runs, **rounds(args))


def run_train_anomaly(spark: SparkSession, args: argparse.Namespace) -> None:
    demo = (lambda: synthetic.outlier_transactions(synthetic.demo_users(spark, 3))) if args.demo else None
    training.anomaly_job(load_transactions(spark, args), args.out, args.runs, demo)


def rounds(args: argparse.Namespace) -> dict:
    return {"maxIter": args.rounds} if args.rounds else {}


def run_predict_category(spark: SparkSession, args: argparse.Namespace) -> None:
    """Requests, or with ``--transactions`` the latest month of every user and category."""
    model, _, _ = artifacts.load_model(spark, args.model)
    if args.transactions:
        tx = load_transactions(spark, args)
        requests = materialise(monthly.scoring_rows(monthly.monthly_features(tx)), "requests")
        keys = ("user_id", "year_month")
    else:
        requests, keys = spark.read.schema(schemas.CATEGORY_REQUEST).json(args.input), ()
    write_both(*scoring.predict_category(requests, model, *keys), args.out)


def run_predict_weekly(spark: SparkSession, args: argparse.Namespace) -> None:
    """Requests, or with ``--transactions`` the last four weeks of every user."""
    model, lags, _ = artifacts.load_model(spark, args.model)
    if args.transactions:
        tx = load_transactions(spark, args)
        requests = materialise(weekly.latest_weeks(weekly.weekly_spend(tx)), "requests")
        keys = ("user_id", "last_week")
    else:
        requests, keys = spark.read.schema(schemas.WEEKLY_REQUEST).json(args.input), ()
    write_both(*scoring.predict_weekly(requests, model, lags, *keys), args.out)


def run_analyse_trend(spark: SparkSession, args: argparse.Namespace) -> None:
    """Requests, or with ``--transactions`` every user's latest month against all users' months."""
    if args.transactions:
        compared = peers.with_population_mean(monthly.monthly_category(load_transactions(spark, args)))
        scoring.deviation_results(compared, "user_id").write.parquet(os.path.join(args.out, "results"))
        return
    requests = spark.read.schema(schemas.TREND_REQUEST).json(args.input)
    write_both(*scoring.analyse_trend(requests), args.out)


def run_check_anomalies(spark: SparkSession, args: argparse.Namespace) -> None:
    """Requests, or with ``--transactions`` whole transactions, whose features are derived."""
    model = training.load_anomaly_model(spark, args.model)
    if args.transactions:
        tx = load_transactions(spark, args)
        both = scoring.check_transactions(tx, model.averages, model.forest)
    else:
        requests = spark.read.schema(schemas.ANOMALY_REQUEST).json(args.input)
        both = scoring.check_requests(requests, model.forest)
    write_both(*both, args.out)


def run_stream_anomalies(spark: SparkSession, args: argparse.Namespace) -> None:
    """Parquet files of normalised transactions, as they arrive in the input folder."""
    model = training.load_anomaly_model(spark, args.model)
    scored = stream.score_stream(stream.read_stream(spark, args.input, schemas.TRANSACTIONS), model)
    stream.write_scored(scored, args.out, args.once).awaitTermination()


JOBS = {
    "ingest": run_ingest,
    "train-category": run_train_category,
    "sequences": run_sequences,
    "train-weekly": run_train_weekly,
    "train-anomaly": run_train_anomaly,
    "predict-category": run_predict_category,
    "predict-weekly": run_predict_weekly,
    "analyse-trend": run_analyse_trend,
    "check-anomalies": run_check_anomalies,
    "stream-anomalies": run_stream_anomalies,
}


READING = {"format", "multiline", "date_format"}
# Options that a job uses besides --input and --out; those in READING only where it reads transactions.
USES = {
    "ingest": READING | {"demo"},
    "train-category": READING | {"demo", "runs", "rounds"},
    "sequences": READING,
    "train-weekly": {"runs", "rounds"},
    "train-anomaly": READING | {"demo", "runs"},
    "predict-category": READING | {"transactions", "model"},
    "predict-weekly": READING | {"transactions", "model"},
    "analyse-trend": READING | {"transactions"},
    "check-anomalies": READING | {"transactions", "model"},
    "stream-anomalies": {"model", "once"},
}


def checked(options: argparse.ArgumentParser, args: argparse.Namespace) -> argparse.Namespace:
    """Ends with a message if the job would ignore an option, or lacks its model."""
    used = USES[args.job] | {"job", "input", "out"}
    if "transactions" in used and not args.transactions:
        used -= READING
    ignored = [name for name, value in vars(args).items() if name not in used and value != options.get_default(name)]
    if ignored:
        options.error(f"{args.job} does not use {sorted(ignored)} here")
    if "model" in used and args.model is None:
        options.error(f"{args.job} needs --model")
    return args


def parser() -> argparse.ArgumentParser:
    options = argparse.ArgumentParser(prog="spendspark", description=__doc__)
    options.add_argument("job", choices=JOBS)
    options.add_argument("--input", required=True, help="transactions, sequences or requests")
    options.add_argument("--out", required=True, help="model, sequences, snapshot root or result folder")
    options.add_argument("--format", choices=["csv", "json", "snapshot"], default="csv", help="of transactions")
    options.add_argument("--multiline", action="store_true", help="records may span lines")
    options.add_argument("--date-format", help="of transactions in text files, if not ISO")
    options.add_argument("--transactions", action="store_true", help="score transactions instead of requests")
    options.add_argument("--model", help="stored model to score with")
    options.add_argument("--runs", default="runs", help="run log to append to")
    options.add_argument("--rounds", type=int, help="boosting rounds, if not the default")
    options.add_argument("--demo", action="store_true", help="use demo data if there is too little")
    options.add_argument("--once", action="store_true", help="stop the stream when all files are read")
    return options


def main(argv: list[str] | None = None) -> None:
    options = parser()
    args = checked(options, options.parse_args(argv))
    JOBS[args.job](build_session(f"spendspark-{args.job}"), args)


if __name__ == "__main__":
    main()
