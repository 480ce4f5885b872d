import numpy as np
import pytest
from pyspark.sql import functions as F

from spendspark.operators import regression


def columns(*names):
    return [F.col(n) for n in names]


def frame(spark, rows):
    return spark.createDataFrame([tuple(map(float, r)) for r in rows], "a double, b double, y double")


def test_weights_equal_numpy(spark):
    rng = np.random.default_rng(4)
    rows = np.round(rng.normal(size=(500, 3)) * [3, 0.2, 1], 6)
    rows[:, 2] = np.round(rows[:, 2] + 2 * rows[:, 0] - 5 * rows[:, 1] + 0.7, 6)
    df = frame(spark, rows)
    fitted = regression.fit(df, columns("a", "b"), F.col("y"))
    want = np.linalg.lstsq(np.column_stack([np.ones(500), rows[:, :2]]), rows[:, 2], rcond=None)[0]
    assert [fitted.constant, *fitted.weights] == pytest.approx(want.tolist(), rel=1e-9)
    assert fitted == regression.fit(df.repartition(7), columns("a", "b"), F.col("y"))
    predicted = df.withColumn("p", fitted.predict(columns("a", "b"))).first()
    assert predicted["p"] == pytest.approx(want @ [1, *rows[0, :2]], rel=1e-9)


def test_dependent_inputs_nulls_and_no_rows(spark):
    same = frame(spark, [(i, 2 * i, 3 * i + 1) for i in range(10)])
    fitted = regression.fit(same, columns("a", "b"), F.col("y"))
    assert (fitted.weights, fitted.constant) == ((3.0, 0.0), 1.0)
    with_null = same.union(same.limit(3).withColumn("y", F.lit(None).cast("double")))
    assert regression.fit(with_null, columns("a", "b"), F.col("y")) == fitted
    constant = regression.fit(frame(spark, [(1, 1, 5), (1, 1, 7)]), columns("a", "b"), F.col("y"))
    assert (constant.weights, constant.constant) == ((0.0, 0.0), 6.0)
    none = regression.fit(same.where("a < 0"), columns("a", "b"), F.col("y"))
    assert (none.weights, none.constant) == ((0.0, 0.0), 0.0)


def test_one_aggregate_without_python(spark):
    df = spark.range(100).select(F.rand(1).alias("a"), F.rand(2).alias("b"), F.rand(3).alias("y"))
    sums = regression.gram(df, columns("a", "b"), F.col("y"))
    assert sums[0][0] == 100 and sums == [list(c) for c in zip(*sums)]
