import random
from datetime import date, timedelta

import numpy as np
import pandas as pd
import pytest
from conftest import rows_of
from pyspark.sql import functions as F

from spendspark.operators import weekly


def random_transactions(seed, users=12):
    """Sparse and dense users, refunds, silent users and long gaps."""
    rng = random.Random(seed)
    rows = []
    for user in range(users):
        step = rng.choice([1, 3, 20, 90])
        day = date(2024, 1, 1) + timedelta(days=rng.randrange(30))
        for _ in range(rng.randrange(1, 40)):
            amount = rng.choice([0, -50, rng.randrange(1, 100_000) / 100, rng.randrange(1, 500)])
            if user % 6 == 5:
                amount = -abs(amount)
            rows.append((user, rng.randrange(1, 4), amount, day.isoformat()))
            day += timedelta(days=rng.randrange(0, 2 * step + 1))
    return rows


def expected_sequences(rows, active):
    """Straight from the definition, one user at a time."""
    result = {}
    frame = pd.DataFrame(rows, columns=["user", "category", "amount", "date"])
    frame["date"] = pd.to_datetime(frame["date"])
    for user, part in frame.groupby("user"):
        series = part.set_index("date")["amount"].astype(float).resample("W-SUN").sum().round(2)
        if len(series) < 5:
            continue
        positive = series[series > 0]
        scale = max(np.percentile(positive, 95), 1.0) if len(positive) else 1.0
        scaled = (series / scale).clip(0, 3).to_numpy()
        for i in range(4, len(scaled)):
            x, y = scaled[i - 4 : i], scaled[i]
            if not active or x.sum() > 0.001 or y > 0.001:
                result[user, series.index[i].date()] = [*x, y, scale]
    return result


@pytest.mark.parametrize("seed", range(4))
@pytest.mark.parametrize("active", [False, True])
def test_sequences_against_brute_force(tx, seed, active):
    rows = random_transactions(seed)
    build = weekly.active_sequences if active else weekly.sequences
    got = {
        (r.user_id, r.target_week): [*r.x, r.y, r.scale]
        for r in build(weekly.weekly_spend(tx(*rows))).collect()
    }
    want = expected_sequences(rows, active)
    assert got.keys() == want.keys() and len(want) > 50
    for key, values in want.items():
        assert got[key] == pytest.approx(values, abs=1e-9)


def test_short_cut_equals_filtering_the_dense_sequences(spark):
    from spendspark.sources.adapters import tx_orders

    week = weekly.weekly_spend(tx_orders(spark, "/root/testdata/sf0.001"))
    fast, slow = weekly.active_sequences(week), weekly.keep_active(weekly.sequences(week))
    assert fast.count() == slow.count() > 0
    assert fast.exceptAll(slow).isEmpty()


def test_gap_filling_is_per_user(tx):
    series = weekly.weekly_series(
        tx((1, 1, 10, "2025-01-05"), (1, 1, 5, "2025-01-20"), (2, 1, 7, "2025-03-01"), (1, 2, 1, "2025-01-03"))
    )
    assert rows_of(series, "user_id", "week_end") == [
        (1, date(2025, 1, 5), 11.0),
        (1, date(2025, 1, 12), 0.0),
        (1, date(2025, 1, 19), 0.0),
        (1, date(2025, 1, 26), 5.0),
        (2, date(2025, 3, 2), 7.0),
    ]


def weeks(user, amounts, start=date(2025, 1, 6)):
    return [(user, 1, a, (start + timedelta(days=7 * i)).isoformat()) for i, a in enumerate(amounts)]


def test_more_than_four_weeks_are_needed(tx):
    week = weekly.weekly_spend(tx(*weeks(1, [1, 2, 3, 4]), *weeks(2, [1, 2, 3, 4, 5])))
    assert [r.user_id for r in weekly.sequences(week).collect()] == [2]
    latest = {r.user_id: r.weekly_spending for r in weekly.latest_weeks(week).collect()}
    assert latest == {1: [1.0, 2.0, 3.0, 4.0], 2: [2.0, 3.0, 4.0, 5.0]}


def test_latest_weeks_after_a_long_gap(tx):
    week = weekly.weekly_spend(tx((1, 1, 9, "2024-01-01"), (1, 1, 5, "2025-01-01"), (2, 1, 5, "2025-01-01")))
    assert [tuple(r) for r in weekly.latest_weeks(week).collect()] == [(1, date(2025, 1, 5), [0.0, 0.0, 0.0, 5.0])]


def test_scale(tx):
    week = weekly.weekly_spend(
        tx(*weeks(1, [-5, 0, -1]), *weeks(2, [0.25, 0.5]), *weeks(3, [10, 0, 20]), *weeks(4, range(1, 12)))
    )
    scales = dict(rows_of(weekly.user_scale(week)))
    assert scales == {1: 1.0, 2: 1.0, 3: 19.5, 4: 10.5}
    assert dict(rows_of(weekly.with_scale(week).select("user_id", "scale").distinct())) == scales


def test_normalised_values_are_bounded(tx):
    amounts = [*[1] * 30, 1000, -7]
    series = weekly.normalised_series(weekly.weekly_spend(tx(*weeks(1, amounts))))
    scaled = [r.scaled for r in series.orderBy("week_end").collect()]
    assert scaled[30] == 3.0 and scaled[31] == 0.0 and scaled[0] == pytest.approx(1 / series.first().scale)


def test_sequence_count_follows_from_the_weeks(spark):
    from spendspark.sources.adapters import tx_events

    week = weekly.weekly_spend(tx_events(spark, "/root/testdata/sf0.01"))
    expected = (
        weekly.fill_gaps(week).groupBy("user_id").count()
        .agg(F.sum(F.greatest(F.col("count") - 4, F.lit(0)))).first()[0]
    )
    assert weekly.sequences(week).count() == expected == 149


def test_spending_lists_are_in_time_order(tx):
    lists = weekly.spending_lists(weekly.weekly_spend(tx(*weeks(1, [3, 1, 2]), (2, 1, 4, "2025-01-01"))))
    assert rows_of(lists, "user_id") == [(1, [3.0, 1.0, 2.0]), (2, [4.0])]
