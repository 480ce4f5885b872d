"""Minimum-data checks before training."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Least number of rows the jobs accept.
MIN_CATEGORY_TRANSACTIONS = 100
MIN_CATEGORY_ROWS = 5
MIN_ANOMALY_TRANSACTIONS = 50


class TooLittleData(ValueError):
    """The input has fewer rows than a training job needs."""


def has_fewer_than(df: DataFrame, n: int) -> bool:
    """True below n rows; reads only as many partitions as it takes to see n of them."""
    return len(df.select(F.lit(1)).take(n)) < n


def at_least(df: DataFrame, n: int, what: str, demo: Callable[[], DataFrame] | None = None) -> DataFrame:
    """``df`` itself when it has n rows; otherwise the demo data, if the caller asked for it."""
    if not has_fewer_than(df, n):
        return df
    if demo is None:
        raise TooLittleData(f"{what}: fewer than {n} rows")
    return demo()
