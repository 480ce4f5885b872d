from datetime import date

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from spendspark.functions import calendar, labels, numeric
from spendspark.functions.parsing import parse_amount, parse_date, parse_id


@pytest.mark.parametrize(
    "text, expected",
    [
        ("1", 1), ("1e5", 100_000), (" 12 ", 12), ("1.", 1), ("+5", 5), (".5", 0.5), ("-3.25", -3.25),
        ("1,000", 0), ("", 0), ("  ", 0), ("abc", 0), ("1_000", 0), ("0x10", 0), ("12d", 0), ("12f", 0),
        ("NaN", 0), ("true", 0), (None, 0), ("inf", 0), ("-Infinity", 0), ("e5", 0), (".", 0),
    ],
)
def test_amount_text(evaluate, spark, text, expected):
    frame = spark.createDataFrame([(text,)], "t string")
    assert float(frame.select(parse_amount(F.col("t"))).first()[0]) == expected


def test_amount_beyond_the_money_type_is_null(spark):
    frame = spark.createDataFrame([("1e30",), ("0.000001",), (None,)], "t string")
    found = [r[0] if r[0] is None else float(r[0]) for r in frame.select(parse_amount(F.col("t"))).collect()]
    assert found == [None, 0.000001, 0.0]


@pytest.mark.parametrize(
    "text, expected",
    [
        ("2025-01-06", date(2025, 1, 6)), ("2025-1-6", date(2025, 1, 6)),
        ("2025-01-06 23:59:59", date(2025, 1, 6)), (" 2025-01-06 ", date(2025, 1, 6)),
        ("", None), ("  ", None), (None, None), ("NaN", None), ("NaT", None), ("null", None),
    ],
)
def test_date_text(spark, text, expected):
    frame = spark.createDataFrame([(text,)], "t string")
    assert frame.select(parse_date(F.col("t"))).first()[0] == expected


def test_bad_date_text_raises(spark):
    frame = spark.createDataFrame([("yesterday",)], "t string")
    with pytest.raises(PySparkException):
        frame.select(parse_date(F.col("t"))).collect()


@pytest.mark.parametrize("text, expected", [("7", 7), ("7.0", 7), ("", None), ("nan", None), (str(2**62), 2**62)])
def test_id_text(spark, text, expected):
    frame = spark.createDataFrame([(text,)], "t string")
    assert frame.select(parse_id(F.col("t"))).first()[0] == expected


def test_weeks_close_on_sunday(spark):
    moments = ["2025-01-05 00:00:00", "2025-01-05 23:59:59", "2025-01-06 00:00:00", "2025-01-12 12:00:00"]
    frame = spark.createDataFrame([(m,) for m in moments], "m string").select(F.col("m").cast("timestamp_ntz").alias("m"))
    ends = [r[0] for r in frame.orderBy("m").select(calendar.week_end(F.col("m"))).collect()]
    assert ends == [date(2025, 1, 5), date(2025, 1, 5), date(2025, 1, 12), date(2025, 1, 12)]


def test_days_count_from_monday(evaluate):
    monday, sunday = date(2025, 1, 6), date(2025, 1, 12)
    assert evaluate(calendar.day_of_week(F.col("d")), d=monday) == 0
    assert evaluate(calendar.day_of_week(F.col("d")), d=sunday) == 6


def test_clip_keeps_null(spark):
    frame = spark.createDataFrame([(None,), (-1.0,), (2.0,), (9.0,)], "v double")
    assert [r[0] for r in frame.select(numeric.clip(F.col("v"), 0.0, 5.0)).collect()] == [None, 0.0, 2.0, 5.0]


def test_ratio_with_zero_denominator(evaluate):
    assert evaluate(numeric.safe_ratio(F.col("a"), F.col("b")), a=7.0, b=0.0) == 7.0
    assert evaluate(numeric.safe_ratio(F.col("a"), F.col("b")), a=7.0, b=2.0) == 3.5


@pytest.mark.parametrize("value, expected", [(-3.0, 0.0), (float("nan"), 0.0), (2.5, 2.5)])
def test_forecast_floor(evaluate, value, expected):
    assert evaluate(numeric.floor_at_zero(F.col("v")), v=value) == expected


@pytest.mark.parametrize("value, expected", [(0.5, 0.0), (1.5, 2.0), (2.5, 2.0), (-2.5, -2.0), (-0.3, -0.0)])
def test_money_rounds_half_to_even(evaluate, value, expected):
    result = evaluate(numeric.money_round(F.col("v")), v=value)
    assert (result, str(result)) == (expected, str(expected)) == (round(value, 0), str(round(value, 0)))


@pytest.mark.parametrize(
    "value, base, fallback, expected",
    [(110.0, 100.0, 50.0, 10.0), (110.0, 0.0, 50.0, 120.0), (110.0, 0.0, 0.0, 0.0), (90.0, -5.0, 100.0, -10.0)],
)
def test_percent_change_chain(evaluate, value, base, fallback, expected):
    column = numeric.percent_change_or(F.col("v"), F.col("r"), F.col("f"))
    assert evaluate(column, v=value, r=base, f=fallback) == pytest.approx(expected)


@pytest.mark.parametrize(
    "change, label",
    [(10.0, "stable"), (10.01, "increasing"), (-10.0, "stable"), (-10.01, "decreasing"), (0.0, "stable")],
)
def test_trend_edges(evaluate, change, label):
    assert evaluate(labels.trend_label(F.col("c")), c=change) == label


@pytest.mark.parametrize(
    "deviation, label, message",
    [
        (-20.5, "below_average", "Bạn đang chi tiêu ít hơn 20% so với mức trung bình. Rất tiết kiệm!"),
        (-20.0, "average", "Chi tiêu của bạn nằm trong mức trung bình (-20%)."),
        (-0.3, "average", "Chi tiêu của bạn nằm trong mức trung bình (-0%)."),
        (0.0, "average", "Chi tiêu của bạn nằm trong mức trung bình (+0%)."),
        (20.0, "average", "Chi tiêu của bạn nằm trong mức trung bình (+20%)."),
        (20.1, "above_average", "Bạn đang chi tiêu nhiều hơn 20% so với mức trung bình. Cân nhắc điều chỉnh."),
        (50.0, "above_average", "Bạn đang chi tiêu nhiều hơn 50% so với mức trung bình. Cân nhắc điều chỉnh."),
        (1234.5, "warning", "⚠️ Cảnh báo: Chi tiêu vượt 1234% so với xu hướng số đông!"),
    ],
)
def test_deviation_edges(evaluate, deviation, label, message):
    assert evaluate(labels.deviation_label(F.col("d")), d=deviation) == label
    assert evaluate(labels.deviation_message(F.col("d")), d=deviation) == message


@pytest.mark.parametrize(
    "flag, amount, ratio, message",
    [
        (False, 9e9, 9.0, "Giao dịch bình thường."),
        (True, 1234567.5, 3.25, "Giao dịch 1,234,568₫ cao gấp 3.2x so với mức bình thường của danh mục này!"),
        (True, 2500.5, 3.0, "Giao dịch 2,500₫ cao hơn đáng kể so với thói quen chi tiêu của bạn."),
        (True, 0.5, 2.0, "Giao dịch 0₫ có dấu hiệu bất thường về thời điểm hoặc mức chi."),
    ],
)
def test_anomaly_messages(evaluate, flag, amount, ratio, message):
    column = labels.anomaly_message(F.col("flag"), F.col("amount"), F.col("ratio"))
    assert evaluate(column, flag=flag, amount=amount, ratio=ratio) == message


def test_hash_unit_is_uniform_and_repeatable(spark):
    draws = spark.range(10_000).select(numeric.hash_unit(F.lit(1), F.col("id")).alias("u"))
    low, high, mean = draws.agg(F.min("u"), F.max("u"), F.avg("u")).first()
    assert 0 <= low < 0.01 and 0.99 < high < 1 and abs(mean - 0.5) < 0.02
    assert draws.repartition(3).agg(F.sum(F.col("u").cast("decimal(38,20)"))).first() == draws.agg(
        F.sum(F.col("u").cast("decimal(38,20)"))
    ).first()


@pytest.mark.parametrize("low, high", [(1, 3), (1, 5), (0, 0), (3, 9)])
def test_few_values_by_comparing_digits(spark, low, high):
    n = high - low + 1
    units = {0, (1 << 52) - 1} | {min(max(i * (1 << 52) // n + d, 0), (1 << 52) - 1) for i in range(n + 1) for d in (-1, 0, 1)}
    rows = spark.createDataFrame([(f"{u:013x}",) for u in units], "digits string").union(
        spark.range(2000).select(numeric.hash_digits(F.col("id")))
    )
    plain = F.floor(numeric.unit_of(F.col("digits")) * n) + low
    assert rows.where(numeric.uniform_of(F.col("digits"), low, high) != plain).isEmpty()
    assert numeric.least_digits(lambda unit: unit >= 2) > "f" * 13


def test_a_draw_for_a_user_is_made_before_its_days(spark):
    from spendspark.sources import synthetic

    users = synthetic.demo_users(spark, 3)
    for tx in (synthetic.seasonal_transactions(users), synthetic.outlier_transactions(users)):
        plan = tx._jdf.queryExecution().executedPlan().toString()
        above, below = plan.split("Generate", 1)
        assert "base)" not in above and "base)" in below and "conv(" not in below.split("explode", 1)[1].split("\n")[0]
