"""Ratios, clipping, percent change and half-even rounding."""

from __future__ import annotations

import math
from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F


def safe_ratio(numerator: Column, denominator: Column) -> Column:
    """Divide, with a denominator of 0 replaced by 1."""
    return numerator / F.when(denominator == 0, F.lit(1.0)).otherwise(denominator)


def clip(value: Column, low: float, high: float) -> Column:
    """Bound a value; null stays null (``least`` and ``greatest`` alone would skip it)."""
    bounded = F.least(F.greatest(value, F.lit(low)), F.lit(high))
    return F.when(value.isNotNull(), bounded)


def floor_at_zero(prediction: Column) -> Column:
    """A forecast is never negative; NaN counts as 0."""
    return F.greatest(F.nanvl(prediction, F.lit(0.0)), F.lit(0.0))


def percent_change(value: Column, base: Column) -> Column:
    return (value - base) / base * 100


def percent_change_or(value: Column, base: Column, fallback: Column) -> Column:
    """Percent change against the base, else against the fallback, else 0."""
    return (
        F.when(base > 0, percent_change(value, base))
        .when(fallback > 0, percent_change(value, fallback))
        .otherwise(0.0)
    )


def half_even(value: Column, places: int) -> Column:
    """Round half to even; a small negative value becomes -0.0, as in floating-point rounding."""
    rounded = F.bround(value, places)
    return F.when((value < 0) & (rounded == 0), -0.0).otherwise(rounded)


def money_round(value: Column) -> Column:
    return half_even(value, 0)


def percent_round(value: Column) -> Column:
    return half_even(value, 1)


def score_round(value: Column) -> Column:
    return half_even(value, 4)


def array_sum(values: Column) -> Column:
    return F.aggregate(values, F.lit(0.0), lambda total, v: total + v)


def array_mean(values: Column) -> Column:
    """Mean of a non-empty array; null for an empty one."""
    return F.when(F.size(values) > 0, array_sum(values) / F.size(values))


def scale_by_peak(values: Column) -> Column:
    """Every element divided by the largest one (1 if that is not positive), at most 3; null stays null."""
    peak = peak_or_one(values)
    return F.transform(values, lambda v: F.when(v.isNotNull(), F.least(v / peak, F.lit(3.0))))


def peak_or_one(values: Column) -> Column:
    peak = F.array_max(values)
    return F.when(peak > 0, peak).otherwise(1.0)


def hash_digits(*parts: Column) -> Column:
    """The 13 hexadecimal digits behind ``hash_unit``; as text they are in the order of its numbers."""
    return F.substring(F.md5(F.concat_ws("|", *[p.cast("string") for p in parts])), 1, 13)


def unit_of(digits: Column) -> Column:
    # Below 2**52, so whole numbers and doubles alike hold it; a long text is read faster as the former.
    return F.conv(digits, 16, 10).cast("bigint").cast("double") / F.lit(float(1 << 52))


def hash_unit(*parts: Column) -> Column:
    """A number in [0, 1) that depends on the parts only, never on partitioning or retries."""
    return unit_of(hash_digits(*parts))


def least_digits(holds: Callable[[float], bool]) -> str:
    """The smallest digits whose number fulfils a condition that holds for all larger ones, too."""
    low, high = 0, 1 << 52
    while low < high:
        middle = (low + high) // 2
        low, high = (low, middle) if holds(middle / float(1 << 52)) else (middle + 1, high)
    # Past the last number: a text after all digits.
    return f"{low:013x}" if low < 1 << 52 else "g"


def uniform_of(digits: Column, low: int, high: int) -> Column:
    """``low`` + floor(unit * (high - low + 1)), by comparing texts: for few values that is faster."""
    n = high - low + 1
    steps = [digits >= least_digits(lambda unit, i=i: math.floor(unit * n) >= i) for i in range(1, n)]
    return reduce(lambda total, step: total + step.cast("bigint"), steps, F.lit(low).cast("bigint"))
