from datetime import date

import pytest
from conftest import rows_of
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException

from spendspark.operators import clean
from spendspark.operators.clean import normalise
from spendspark.plans.ingest import ingest_job
from spendspark.sources import artifacts, guards, synthetic, transactions

HEADERLESS = (
    '1,1,1,300000,2025-01-01,ăn sáng\n2,1,2,abc,2025-01-02,"mua ""đồ"", rẻ"\n'
    "3,,1,5,2025-01-03,x\n4,2,,5,2025-01-03,x\n5,2,1,5,,x\n"
)


def write(path, text):
    path.write_text(text, encoding="utf-8")
    return str(path)


def test_headerless_csv(spark, tmp_path):
    tx = normalise(transactions.read_csv(spark, write(tmp_path / "t.csv", HEADERLESS)))
    assert [(r.transaction_id, r.user_id, r.category_id, float(r.amount), r.date, r.note) for r in tx.collect()] == [
        (1, 1, 1, 300000.0, date(2025, 1, 1), "ăn sáng"),
        (2, 1, 2, 0.0, date(2025, 1, 2), 'mua "đồ", rẻ'),
        (3, None, 1, 5.0, date(2025, 1, 3), "x"),
        (4, 2, None, 5.0, date(2025, 1, 3), "x"),
    ]


def test_rejected_rows_have_reasons(spark, tmp_path):
    text = HEADERLESS + "6,,,5,2025-01-03,x\n7,1,1,1e30,2025-01-03,x\n"
    raw = transactions.read_csv(spark, write(tmp_path / "t.csv", text))
    assert {r.transaction_id: r.error for r in clean.rejected(raw).collect()} == {
        5: clean.NO_DATE, 6: clean.NO_KEY, 7: clean.TOO_LARGE,
    }


def test_files_with_other_headers_raise(spark, tmp_path):
    folder = tmp_path / "mixed"
    folder.mkdir()
    write(folder / "a.csv", "user_id,category_id,amount,date\n1,2,3,2025-01-01\n")
    write(folder / "b.csv", "category_id,user_id,amount,date\n77,4,3,2025-01-01\n")
    with pytest.raises((PySparkException, Py4JJavaError)):
        transactions.read_csv(spark, str(folder)).collect()


def test_broken_json_lines_are_rejected(spark, tmp_path):
    text = '{"user_id": 1, "category_id": 2, "amount": 3, "transaction_date": "2025-01-01"}\n{"user_id": \n'
    raw = transactions.read_json(spark, write(tmp_path / "t.json", text))
    assert [r.date for r in normalise(raw).collect()] == [date(2025, 1, 1)]
    assert [(r.error, r.corrupt_record) for r in clean.rejected(raw).collect()] == [(clean.NOT_A_RECORD, '{"user_id": ')]


@pytest.mark.parametrize("date_name", ["date", "transaction_date"])
def test_csv_columns_are_taken_by_name(spark, tmp_path, date_name):
    text = f"amount,{date_name},user_id,type,category_id\n12.50,2025-1-6,7.0,expense,3\n"
    tx = normalise(transactions.read_csv(spark, write(tmp_path / "t.csv", text)))
    row = tx.first()
    assert (row.user_id, row.category_id, float(row.amount), row.date) == (7, 3, 12.5, date(2025, 1, 6))
    assert row.transaction_id is None and row.note is None


def test_csv_without_a_needed_column(spark, tmp_path):
    with pytest.raises(ValueError, match="user_id"):
        transactions.read_csv(spark, write(tmp_path / "t.csv", "amount,date,category_id\n1,2025-01-01,1\n"))


def test_missing_file_is_an_error(spark, tmp_path):
    with pytest.raises(AnalysisException):
        transactions.read_csv(spark, str(tmp_path / "none.csv"))


@pytest.mark.parametrize(
    "text, multiline",
    [
        ('{"user_id":1,"category_id":2,"amount":3.5,"date":"2025-01-01"}\n', False),
        ('[\n {"user_id":1,"category_id":2,\n "amount":3.5,"date":"2025-01-01"}\n]', True),
    ],
)
def test_json_records(spark, tmp_path, text, multiline):
    row = normalise(transactions.read_json(spark, write(tmp_path / "t.json", text), multiline)).first()
    assert (row.user_id, row.category_id, float(row.amount), row.date) == (1, 2, 3.5, date(2025, 1, 1))


def test_snapshots_keep_the_last_full_batch(spark, tx, tmp_path):
    root = str(tmp_path / "snapshots")
    assert transactions.current_snapshot(spark, root) is None
    with pytest.raises(FileNotFoundError):
        transactions.read_snapshot(spark, root)
    first, second = tx((1, 1, 10, "2025-01-01")), tx((2, 1, 10, "2025-01-01"), (2, 1, 20, "2025-01-02"))
    one = transactions.publish_snapshot(first, root)
    assert transactions.publish_snapshot(first.limit(0), root) == one
    transactions.publish_snapshot(second, root)
    assert transactions.read_snapshot(spark, root).count() == 2
    assert spark.read.parquet(one).count() == 1


def test_ingest_falls_back_to_the_last_snapshot(spark, tx, tmp_path):
    root, landing = str(tmp_path / "root"), tmp_path / "landing"
    read = lambda: transactions.read_json(spark, str(landing))
    with pytest.raises(AnalysisException):
        ingest_job(spark, read, root)
    demo = ingest_job(spark, read, root, demo=lambda: synthetic.tiny_transactions(synthetic.demo_users(spark, 2, 101)))
    assert spark.read.parquet(demo).count() == 20
    assert ingest_job(spark, read, root) == demo
    landing.mkdir()
    write(landing / "a.json", '{"user_id":1,"category_id":2,"amount":3.5,"date":"2025-01-01"}\n')
    assert spark.read.parquet(ingest_job(spark, read, root)).count() == 1


def test_empty_sequences_are_stored_with_their_schema(spark, tmp_path):
    empty = spark.createDataFrame([], "user_id long, target_week date, x array<double>, y double, scale double")
    artifacts.write_sequences(empty, 4, str(tmp_path / "s"))
    seqs, window = artifacts.read_sequences(spark, str(tmp_path / "s"))
    assert (seqs.count(), window, seqs.columns) == (0, 4, empty.columns)


def test_run_log_appends(spark, tmp_path):
    path = str(tmp_path / "runs")
    artifacts.log_run(spark, path, "a", {"depth": 5}, {"rmse": 0.25})
    artifacts.log_run(spark, path, "b", {}, {"rmse": 0.5})
    assert rows_of(artifacts.read_runs(spark, path).select("run_id", "kind", "key", "value")) == [
        ("a", "metric", "rmse", "0.25"),
        ("a", "param", "depth", "5"),
        ("b", "metric", "rmse", "0.5"),
    ]


def test_guards(spark):
    few = spark.range(5)
    assert guards.at_least(few, 5, "few") is few
    with pytest.raises(guards.TooLittleData):
        guards.at_least(few, 6, "few")
    assert guards.at_least(few, 6, "few", demo=lambda: spark.range(9)).count() == 9


def test_tiny_generator(spark):
    tx = synthetic.tiny_transactions(synthetic.demo_users(spark, 2, 101))
    n, low, high, categories, first, last, days = tx.agg(
        F.count("*"), F.min("amount"), F.max("amount"), F.max("category_id"),
        F.min("date"), F.max("date"), F.countDistinct("date"),
    ).first()
    assert (n, days, first, last) == (20, 20, date(2023, 10, 1), date(2023, 10, 20))
    assert 20_000 <= low <= high <= 200_000 and categories <= 5


def test_seasonal_generator(spark):
    tx = synthetic.seasonal_transactions(synthetic.demo_users(spark, 5))
    assert tx.select("transaction_id").distinct().count() == tx.count()
    per_day = tx.groupBy("user_id", "date").count()
    assert per_day.count() == 5 * 365
    assert rows_of(per_day.agg(F.min("count"), F.max("count"))) == [(1, 3)]
    halves = tx.groupBy((F.dayofmonth("date") > 15).alias("late")).agg(F.avg("amount").alias("mean"))
    early, late = (float(r.mean) for r in halves.orderBy("late").collect())
    assert late > early
    assert tx.where("amount < 15000 or amount > 300000 * 1.31 * 2").count() == 0


def test_outlier_generator(spark):
    tx = synthetic.outlier_transactions(synthetic.demo_users(spark, 30))
    share = tx.agg(F.avg(F.col("is_injected").cast("int"))).first()[0]
    assert 0.04 < share < 0.06
    again = synthetic.outlier_transactions(synthetic.demo_users(spark, 30).repartition(5))
    assert tx.exceptAll(again).count() == 0 and tx.count() == again.count()
