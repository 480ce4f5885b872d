"""Linear least squares by sufficient statistics: one aggregate, whatever the number of rows.

Values are rounded to whole millionths, so the sums of products are exact decimals and the same for any
partitioning. The normal equations, one row and column for each input, are solved in fractions.
"""

from __future__ import annotations

from dataclasses import dataclass
from fractions import Fraction

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

UNITS = 1_000_000


@dataclass(frozen=True)
class Linear:
    """Weights of the inputs, and the constant."""

    weights: tuple[float, ...]
    constant: float

    def predict(self, inputs: list[Column]) -> Column:
        out = F.lit(self.constant)
        for weight, value in zip(self.weights, inputs, strict=True):
            out = out + F.lit(weight) * value
        return out


def gram(rows: DataFrame, inputs: list[Column], target: Column) -> list[list[int]]:
    """Sums of products of 1, the inputs and the target, in millionths; rows with a null anywhere are left out.

    Values should stay below 10**9: products of two have to fit a decimal together with their count.
    """
    names = [f"v{i}" for i in range(len(inputs) + 1)]
    whole = [F.bround(v * UNITS).cast("decimal(15,0)").alias(n) for n, v in zip(names, [*inputs, target], strict=True)]
    ones = rows.select(F.lit(1).cast("decimal(1,0)").alias("one"), *whole).dropna()
    names = ["one", *names]
    pairs = [(i, j) for i in range(len(names)) for j in range(i, len(names))]
    total = [F.sum(F.col(names[i]) * F.col(names[j])).alias(f"s{i}_{j}") for i, j in pairs]
    row = ones.agg(*total).first()
    return [[int(row[f"s{min(i, j)}_{max(i, j)}"] or 0) for j in range(len(names))] for i in range(len(names))]


def solve(sums: list[list[int]]) -> Linear:
    """Weights from the sums; an input that the ones before it determine gets none."""
    size = len(sums) - 1
    left = [[Fraction(sums[i][j]) for j in range(size + 1)] for i in range(size)]
    used = []
    for i in range(size):
        if left[i][i] == 0:
            continue
        used.append(i)
        left[i] = [v / left[i][i] for v in left[i]]
        for k in range(size):
            if k != i and left[k][i] != 0:
                left[k] = [a - left[k][i] * b for a, b in zip(left[k], left[i], strict=True)]
    found = [left[i][size] if i in used else Fraction(0) for i in range(size)]
    # The constant is counted in millionths of the target, the weights are ratios.
    return Linear(tuple(float(v) for v in found[1:]), float(found[0] / UNITS))


def fit(rows: DataFrame, inputs: list[Column], target: Column) -> Linear:
    """Least squares with a constant; without rows everything is 0."""
    return solve(gram(rows, inputs, target))
