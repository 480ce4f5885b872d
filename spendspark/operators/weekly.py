"""Weekly spending per user: dense series, scaling and forecast sequences.

All functions after ``weekly_spend`` work on its rows, at most one per user and week. A user's
history is therefore bounded by the calendar even when one user has a third of all
transactions: the aggregation combines rows before they are shuffled, and only the small
weekly rows meet in one task per user.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql.window import WindowSpec

from spendspark.functions.calendar import week_end
from spendspark.functions.numeric import clip, safe_ratio
from spendspark.operators.clean import has

# Weeks per sequence, scaling percentile, cap and inactivity threshold.
WINDOW_SIZE = 4
SCALE_PERCENTILE = 0.95
SCALE_CAP = 3.0
INACTIVE_BELOW = 0.001


def _weeks() -> WindowSpec:
    return W.partitionBy("user_id").orderBy("week_end")


def _all_weeks() -> WindowSpec:
    """The whole history, in the order of ``_weeks`` so that both need one sort only."""
    return _weeks().rowsBetween(W.unboundedPreceding, W.unboundedFollowing)


def weekly_spend(tx: DataFrame) -> DataFrame:
    """Sum per user and week with transactions, of whatever category; weeks end on Sunday."""
    return (
        tx.where(has("user_id", "date"))
        .select("user_id", week_end(F.col("date")).alias("week_end"), "amount")
        .groupBy("user_id", "week_end")
        .agg(F.sum("amount").cast("double").alias("spend"))
    )


def _empty_after(at_most: int | None = None) -> Column:
    """Number of empty weeks between this row and the user's next one."""
    following = F.lead("week_end").over(_weeks())
    empty = F.coalesce(F.datediff(following, "week_end") / 7 - 1, F.lit(0.0)).cast("int")
    return empty if at_most is None else F.least(empty, F.lit(at_most))


def fill_gaps(weekly: DataFrame) -> DataFrame:
    """Add the weeks without transactions, as 0, between a user's first and last week.

    Each row emits itself and the empty weeks up to the user's next row, so no calendar table
    and no join is needed. Other columns are per user and are repeated.
    """
    others = [c for c in weekly.columns if c not in ("user_id", "week_end", "spend")]
    return (
        weekly.withColumn("empty", _empty_after())
        .withColumn("ahead", F.explode(F.sequence(F.lit(0), F.col("empty"))))
        .select(
            "user_id",
            F.date_add("week_end", F.col("ahead") * 7).alias("week_end"),
            F.when(F.col("ahead") == 0, F.col("spend")).otherwise(0.0).alias("spend"),
            *others,
        )
    )


def weekly_series(tx: DataFrame) -> DataFrame:
    return fill_gaps(weekly_spend(tx))


def _scale(percentile_of_positive: Column) -> Column:
    """At least 1, to four places; that is exact for amounts in cents, of which it lies 1/20ths between two."""
    return F.greatest(F.coalesce(F.bround(percentile_of_positive, 4), F.lit(1.0)), F.lit(1.0))


def _p95_of_positive() -> Column:
    return F.percentile(F.when(F.col("spend") > 0, F.col("spend")), SCALE_PERCENTILE)


def user_scale(weekly: DataFrame) -> DataFrame:
    """The 95th percentile of each user's positive weeks (empty weeks do not matter)."""
    return weekly.groupBy("user_id").agg(_scale(_p95_of_positive()).alias("scale"))


def _scale_of_user() -> Column:
    return _scale(_p95_of_positive().over(_all_weeks()))


def with_scale(weekly: DataFrame) -> DataFrame:
    return weekly.withColumn("scale", _scale_of_user())


def _scaled(spend: Column) -> Column:
    return clip(safe_ratio(spend, F.col("scale")), 0.0, SCALE_CAP)


def normalised_series(weekly: DataFrame) -> DataFrame:
    """Dense series with each value relative to the user's own scale, from 0 to 3."""
    return fill_gaps(with_scale(weekly)).withColumn("scaled", _scaled(F.col("spend")))


def _recent(weeks: int) -> list[Column]:
    """Spending of this week and of each of the given number of weeks before it, 0 if empty.

    The n-th row before lies at least n weeks back, so only the first n rows can hold week n.
    """
    distance = [F.datediff("week_end", F.lag("week_end", n).over(_weeks())) for n in range(1, weeks + 1)]
    earlier = [F.lag("spend", n).over(_weeks()) for n in range(1, weeks + 1)]
    return [F.col("spend")] + [
        F.coalesce(*[F.when(distance[n] == 7 * back, earlier[n]) for n in range(back)], F.lit(0.0))
        for back in range(1, weeks + 1)
    ]


def _history_of_at_least(weeks: int, day: Column) -> Column:
    return F.datediff(day, F.col("first_week")) >= 7 * (weeks - 1)


def _sequences(weekly: DataFrame, at_most: int | None = None) -> DataFrame:
    """Four consecutive weeks ``x`` and the following week ``y``, for users with over 4 weeks.

    Each row looks back four weeks before the empty weeks up to the next row are emitted, so the
    many empty weeks are neither sorted nor windowed: their values follow from that row. All
    looks at other rows go through one window, and scaling follows it.
    """
    emitted = (
        weekly.select(
            "user_id",
            "week_end",
            _scale_of_user().alias("scale"),
            F.array(*_recent(WINDOW_SIZE)).alias("spends"),
            F.min("week_end").over(_all_weeks()).alias("first_week"),
            _empty_after(at_most).alias("empty"),
        )
        .withColumn("recent", F.array(*[_scaled(F.col("spends")[n]) for n in range(WINDOW_SIZE + 1)]))
        .drop("spends")
        .withColumn("ahead", F.explode(F.sequence(F.lit(0), F.col("empty"))))
        .withColumn("target_week", F.date_add("week_end", F.col("ahead") * 7))
        .where(_history_of_at_least(WINDOW_SIZE + 1, F.col("target_week")))
    )

    def before_target(weeks: int) -> Column:
        return F.coalesce(F.get("recent", F.lit(weeks) - F.col("ahead")), F.lit(0.0))

    return emitted.select(
        "user_id",
        "target_week",
        F.array(*[before_target(n) for n in range(WINDOW_SIZE, 0, -1)]).alias("x"),
        before_target(0).alias("y"),
        "scale",
    )


def sequences(weekly: DataFrame) -> DataFrame:
    return _sequences(weekly)


def active_sequences(weekly: DataFrame) -> DataFrame:
    """The sequences in which any of the five weeks has spending.

    From the fifth empty week in a row on, every empty week closes an all-zero sequence, so
    emitting no more than four empty weeks per gap gives the same sequences as the dense
    series, at a cost that grows with the transactions and not with the length of the calendar.
    """
    return keep_active(_sequences(weekly, at_most=WINDOW_SIZE))


def keep_active(seqs: DataFrame) -> DataFrame:
    """Element by element, which compiles to plain additions, unlike a function over the array."""
    total = sum((F.col("x")[i] for i in range(1, WINDOW_SIZE)), F.col("x")[0])
    return seqs.where((total > INACTIVE_BELOW) | (F.col("y") > INACTIVE_BELOW))


def latest_weeks(weekly: DataFrame) -> DataFrame:
    """The last four weeks of each user with at least four, as the forecast input."""
    return (
        weekly.select(
            "user_id",
            F.col("week_end").alias("last_week"),
            F.array(*reversed(_recent(WINDOW_SIZE - 1))).alias("weekly_spending"),
            F.min("week_end").over(_all_weeks()).alias("first_week"),
            F.lead("week_end").over(_weeks()).alias("following"),
        )
        .where(F.col("following").isNull() & _history_of_at_least(WINDOW_SIZE, F.col("last_week")))
        .drop("first_week", "following")
    )


def spending_lists(weekly: DataFrame) -> DataFrame:
    """Each user's whole weekly history as one list, oldest first: a raw forecast request."""
    filled = fill_gaps(weekly)
    ordered = F.array_sort(F.collect_list(F.struct("week_end", "spend")))
    return filled.groupBy("user_id").agg(F.transform(ordered, lambda w: w["spend"]).alias("weekly_spending"))
