from datetime import date
from decimal import Decimal
from spendspark.operators import weekly
from spendspark.operators.anomaly import category_average

import pandas as pd
import pytest
from conftest import rows_of
from pyspark.sql import functions as F
from test_weekly import random_transactions

from spendspark.operators import clean, monthly, peers
from spendspark.schemas import CATEGORY_FEATURES, CATEGORY_TARGET, TRANSACTIONS


def test_monthly_aggregate_golden(tx):
    rows = monthly.as_money_totals(
        monthly.monthly_category(
            tx((1, 3, 950, "2025-01-04"), (1, 3, 1200, "2025-01-09"), (1, 3, 870, "2025-01-12"), (1, 4, 0, "2025-02-01"))
        )
    )
    first, second = rows.orderBy("category_id").collect()
    assert (first.monthly_spending, first.transaction_count, first.max_transaction) == (3020.0, 3, 1200.0)
    assert first.avg_transaction == pytest.approx(1006.6666666667)
    assert first.avg_day_of_week == pytest.approx((5 + 3 + 6) / 3)
    assert first.avg_day_of_month == pytest.approx(25 / 3)
    assert (second.year_month, second.monthly_spending) == (date(2025, 2, 1), 0.0)


def test_ratio_and_totals(tx):
    month = monthly.monthly_category(
        tx((1, 1, 30, "2025-01-01"), (1, 2, 10, "2025-01-31"), (1, 1, 0, "2025-02-01"), (2, 1, 5, "2025-01-01"))
    )
    shares = monthly.with_ratio(month).select("user_id", "category_id", "year_month", "category_ratio")
    assert rows_of(shares) == [
        (1, 1, date(2025, 1, 1), 0.75),
        (1, 1, date(2025, 2, 1), 0.0),
        (1, 2, date(2025, 1, 1), 0.25),
        (2, 1, date(2025, 1, 1), 1.0),
    ]
    assert rows_of(monthly.user_month_total(month)) == [
        (1, date(2025, 1, 1), 40.0),
        (1, date(2025, 2, 1), 0.0),
        (2, date(2025, 1, 1), 5.0),
    ]


def test_lags_skip_silent_months(tx):
    spend = {"2025-01-01": 10, "2025-02-01": 20, "2025-07-01": 40, "2025-08-01": 0, "2025-09-01": 5}
    features = monthly.monthly_features(tx(*[(1, 1, a, d) for d, a in spend.items()])).orderBy("year_month")
    columns = ["prev_month_spending", "avg_monthly_spending_3m", "spending_trend", CATEGORY_TARGET]
    got = [tuple(r) for r in features.select(*columns).collect()]
    assert got[0] == (None, None, None, 20.0)
    assert got[1] == (10.0, 10.0, 1.0, 40.0)
    assert got[2] == (20.0, 15.0, pytest.approx(4 / 3), 0.0)
    assert got[3] == (40.0, pytest.approx(70 / 3), pytest.approx(12 / 7), 5.0)
    assert got[4] == (0.0, 20.0, 0.0, None)
    assert monthly.training_rows(features).count() == 3
    assert [r.monthly_spending for r in monthly.scoring_rows(features).collect()] == [5.0]


def test_trend_with_empty_mean_and_cap(tx):
    flat = [("2025-01-01", 0), ("2025-02-01", 0), ("2025-03-01", 1)]
    refund = [("2025-01-01", -9), ("2025-02-01", 1), ("2025-03-01", 9), ("2025-04-01", 1)]
    features = monthly.monthly_features(
        tx(*[(1, 1, a, d) for d, a in flat], *[(2, 1, a, d) for d, a in refund])
    ).orderBy("user_id", "year_month")
    assert [r.spending_trend for r in features.collect()] == [None, 0.0, 0.0, None, 1.0, 0.0, 5.0]


@pytest.mark.parametrize("seed", range(3))
def test_training_rows_against_brute_force(tx, seed):
    rows = [(u, c, max(a, 0) if u % 2 else a, d) for u, c, a, d in random_transactions(seed, users=20)]
    frame = pd.DataFrame(rows, columns=["user_id", "category_id", "amount", "date"]).astype({"amount": float})
    frame["date"] = pd.to_datetime(frame["date"])
    frame["year_month"] = frame["date"].dt.to_period("M").dt.start_time.dt.date
    want = {}
    for (user, category), part in frame.groupby(["user_id", "category_id"]):
        history = sorted(part.groupby("year_month"), key=lambda item: item[0])
        for i in range(1, len(history) - 1):
            month, current = history[i]
            total = round(frame[(frame.user_id == user) & (frame.year_month == month)].amount.sum(), 2)
            spend = [round(p.amount.sum(), 2) for _, p in history]
            before = spend[max(0, i - 3) : i]
            mean = sum(before) / len(before)
            want[user, category, month] = {
                "monthly_spending": spend[i],
                "transaction_count": len(current),
                "avg_transaction": current.amount.mean(),
                "max_transaction": current.amount.max(),
                "avg_day_of_week": current.date.dt.dayofweek.mean(),
                "avg_day_of_month": current.date.dt.day.mean(),
                "total_all_categories": total,
                "category_ratio": spend[i] / (total or 1),
                "prev_month_spending": spend[i - 1],
                "prev_month_count": len(history[i - 1][1]),
                "avg_monthly_spending_3m": mean,
                "spending_trend": min(max(spend[i - 1] / (mean or 1), 0), 5),
                "next_month_spending": spend[i + 1],
                "month": month.month,
                "year": month.year,
            }
    got = {
        (r.user_id, r.category_id, r.year_month): r.asDict()
        for r in monthly.training_rows(monthly.monthly_features(tx(*rows))).collect()
    }
    assert got.keys() == want.keys() and want
    for key, values in want.items():
        assert {k: got[key][k] for k in values} == pytest.approx(values, abs=1e-9)


def test_shares_of_a_month_sum_to_one(spark):
    from spendspark.sources.adapters import tx_lineitem

    shares = monthly.with_ratio(monthly.monthly_category(tx_lineitem(spark, "/root/testdata/sf0.001")))
    sums = shares.groupBy("user_id", "year_month").agg(F.sum("category_ratio").alias("s"))
    assert sums.where(F.abs(F.col("s") - 1) > 1e-9).isEmpty()


def test_each_path_drops_what_it_cannot_group(spark):
    day = date(2025, 1, 1)
    raw = spark.createDataFrame(
        [(1, None, 1, Decimal(7), day, None), (2, 1, None, Decimal(100), day, None), (3, 1, 1, Decimal(50), day, None),
         (4, 1, 1, Decimal(9), None, None), (5, None, None, Decimal(9), day, None)],
        TRANSACTIONS,
    )
    assert sorted(r.transaction_id for r in clean.groupable(raw).collect()) == [1, 2, 3]
    assert [r.spend for r in weekly.weekly_spend(raw).collect()] == [150.0]
    month = monthly.monthly_features(raw).first()
    assert (month.monthly_spending, month.total_all_categories) == (50.0, 150.0)
    assert category_average(raw).first().category_avg == 28.5


def test_feature_columns_are_complete(spark, tx):
    features = monthly.monthly_features(tx((1, 1, 1, "2025-01-01")))
    assert set(CATEGORY_FEATURES) <= set(features.columns)


def test_population_mean_is_over_user_months(tx):
    month = monthly.monthly_category(
        tx((1, 1, 10, "2025-01-01"), (1, 1, 20, "2025-02-01"), (2, 1, 60, "2025-01-01"), (2, 2, 7, "2025-01-01"))
    )
    compared = peers.with_population_mean(month).select(
        "user_id", "category_id", "user_current_spending", "population_mean"
    )
    assert rows_of(compared) == [(1, 1, 20.0, 30.0), (2, 1, 60.0, 30.0), (2, 2, 7.0, 7.0)]
