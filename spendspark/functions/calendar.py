"""Calendar parts used as keys and features."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def week_end(day: Column) -> Column:
    """The Sunday that closes the day's week; a Sunday closes its own week."""
    day = F.to_date(day)
    return F.date_add(day, 6 - F.weekday(day))


def day_of_week(day: Column) -> Column:
    """Monday 0 to Sunday 6."""
    return F.weekday(day)


def day_of_month(day: Column) -> Column:
    return F.dayofmonth(day)


def month_start(day: Column) -> Column:
    return F.trunc(day, "month")
