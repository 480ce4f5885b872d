"""Centroid clustering on whole numbers, with an incremental table of dot products.

Components become integers, floor(scale * x). Each vector carries its exact dot product with every
centroid. When centroids move, only the components in which a centroid really changed are applied:
dot(x, c + d) = dot(x, c) + sum of x_i * d_i over the nonzero d_i. Then the nearest centroid is the
argmin of |c|^2 - 2 dot(x, c), ties to the smaller number. All sums are exact, so neither the
partitioning nor the order of rows shows in the result.

Each round reads the table of the round before and writes its own; that cuts the lineage, and a
lost executor costs the tasks it ran. To the driver come only the sums of each cluster, k rows of
one number per dimension; centroids go out with the tasks, k vectors however many rows there are.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from spendspark.session import materialise

cloudpickle.register_pickle_by_value(sys.modules[__name__])

# Squared distances of vectors with larger components could leave 64 bits.
LARGEST = 1 << 27
# Every whole number up to this one is exact as a double.
EXACT_DOUBLE = 1 << 53
# Vectors that are multiplied at a time.
ROWS_AT_ONCE = 8192


@dataclass
class Clusters:
    """One row per kept vector (id, cluster, distance), and the final centroids."""

    assigned: DataFrame
    centroids: np.ndarray


def whole_vectors(vectors: DataFrame, dims: int, scale: int, id_col: str, vector_col: str) -> DataFrame:
    """(id, cells) of the vectors with exactly ``dims`` components, none null or non-finite."""
    x = F.col(vector_col)
    finite = F.forall(x, lambda v: v.isNotNull() & (F.abs(v.cast("double")) < F.lit(float("inf"))))
    kept = vectors.where(F.coalesce((F.size(x) == dims) & finite, F.lit(False)))
    scaled = F.transform(x, lambda v: F.lit(float(scale)) * v.cast("double"))
    return kept.select(F.col(id_col).alias("id"), scaled.alias("scaled")).select(
        "id",
        F.transform("scaled", lambda v: F.floor(v).cast("int")).alias("cells"),
        F.array_max(F.transform("scaled", F.abs)).alias("size"),
    )


def first_centroids(cells: DataFrame, k: int, salt: str) -> np.ndarray:
    """The k vectors with the smallest SHA-256 of ``salt`` and id, in that order; k rows reach the driver."""
    order = F.sha2(F.concat(F.lit(salt), F.col("id").cast("string")), 256)
    rows = cells.orderBy(order.asc_nulls_last(), "cells").limit(k).select("cells").collect()
    return np.array([r["cells"] for r in rows], dtype=np.int64)


def _matrix(column: pa.Array, dtype) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), -1).astype(dtype)


def _nested(values: np.ndarray) -> pa.Array:
    offsets = np.arange(0, values.size + 1, values.shape[1], dtype=np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values.ravel()))


def _update_task(before: np.ndarray | None, now: np.ndarray, exact: bool):
    """Dot products with the centroids of this round, and the nearest one of each vector.

    Without ``before`` all products are made, else those of before are corrected by the changes.
    Doubles multiply faster and are as exact, as long as no sum of products leaves 53 bits.
    """
    dtype = np.float64 if exact else np.int64
    change = None if before is None else [(j, np.flatnonzero(d), d[d != 0]) for j, d in enumerate(now - before) if d.any()]
    lengths = (now * now).sum(axis=1)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, ROWS_AT_ONCE):
                batch = whole.slice(at, ROWS_AT_ONCE)
                cells = _matrix(batch.column("cells"), dtype)
                if change is None:
                    dots = (cells @ now.T.astype(dtype)).astype(np.int64)
                else:
                    dots = _matrix(batch.column("dots"), np.int64)
                    for j, where, delta in change:
                        dots[:, j] += (cells[:, where] @ delta.astype(dtype)).astype(np.int64)
                away = lengths - 2 * dots
                nearest = away.argmin(axis=1)
                squares = (cells * cells).sum(axis=1).astype(np.int64)
                distance = squares + away[np.arange(len(nearest)), nearest]
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("id"),
                        batch.column("cells"),
                        _nested(dots),
                        pa.array(nearest.astype(np.int32)),
                        pa.array(distance),
                    ],
                    ["id", "cells", "dots", "cluster", "distance"],
                )

    return run


def _sums_task(k: int):
    """Per task, the number of vectors and the sum of every component of each cluster it holds."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, sums = np.zeros(k, dtype=np.int64), None
        for batch in batches:
            if not batch.num_rows:
                continue
            cells, where = _matrix(batch.column("cells"), np.int64), batch.column("cluster").to_numpy()
            order = np.argsort(where, kind="stable")
            there, starts = np.unique(where[order], return_index=True)
            if sums is None:
                sums = np.zeros((k, cells.shape[1]), dtype=np.int64)
            sums[there] += np.add.reduceat(cells[order], starts)
            counts += np.bincount(where, minlength=k)
        if sums is not None:
            held = np.flatnonzero(counts)
            dims = sums.shape[1]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.repeat(held, dims).astype(np.int32)),
                    pa.array(np.tile(np.arange(dims, dtype=np.int32), len(held))),
                    pa.array(np.repeat(counts[held], dims)),
                    pa.array(sums[held].ravel()),
                ],
                ["cluster", "dim", "n", "s"],
            )

    return run


def _moved(assigned: DataFrame, centroids: np.ndarray) -> np.ndarray:
    """Exact floor of the mean of each cluster; an empty one stays where it is."""
    parts = assigned.select("cells", "cluster").mapInArrow(
        _sums_task(len(centroids)), "cluster int, dim int, n bigint, s bigint"
    )
    # Sums of tasks meet as decimals, so that no number of rows overflows them.
    whole = parts.groupBy("cluster", "dim").agg(F.sum("n").alias("n"), F.sum(F.col("s").cast("decimal(28,0)")).alias("s"))
    out = centroids.copy()
    for row in whole.collect():
        out[row["cluster"], row["dim"]] = int(row["s"]) // row["n"]
    return out


def cluster(
    vectors: DataFrame,
    k: int = 40,
    rounds: int = 5,
    dims: int = 64,
    scale: int = 256,
    salt: str = "2:",
    id_col: str = "vec_id",
    vector_col: str = "embedding",
) -> Clusters:
    """Assign and move ``rounds`` times, then assign once more.

    Vectors that are null, of another length, or with a null or non-finite component are left out. Rows
    that share an id or a vector are rows of their own; among equal ids the smaller vector starts first,
    and rows without an id start last. With fewer than k vectors each starts a cluster; an empty table
    gives no rows. Other columns are not read, so their names do not matter. A component beyond 2**27
    after scaling raises, since its distances would not be whole 64-bit numbers.
    """
    checked = whole_vectors(vectors, dims, scale, id_col, vector_col)
    largest = checked.agg(F.max("size")).first()[0]
    if largest is not None and largest >= LARGEST:
        raise ValueError(f"a component of {largest} after scaling is beyond {LARGEST}")
    cells = checked.select("id", "cells")
    kind = cells.schema["id"].dataType.simpleString()
    narrow = dims * ((largest or 0) + 1) ** 2
    products = "int" if narrow < 1 << 31 else "bigint"
    schema = f"id {kind}, cells array<int>, dots array<bigint>, cluster int, distance bigint"
    centroids = first_centroids(cells, k, salt)
    if not len(centroids):
        return Clusters(cells.select("id", F.lit(0).alias("cluster"), F.lit(0).cast("bigint").alias("distance")), centroids)
    table, before = cells, None
    for step in range(rounds + 1):
        made = table.mapInArrow(_update_task(before, centroids, narrow < EXACT_DOUBLE), schema)
        if step == rounds:
            return Clusters(materialise(made.select("id", "cluster", "distance"), "clusters"), centroids)
        # Products that fit 32 bits are stored in them.
        stored = made.withColumn("dots", F.col("dots").cast(f"array<{products}>"))
        table = materialise(stored.select("id", "cells", "dots", "cluster"), "cluster-dots")
        before, centroids = centroids, _moved(table, centroids)


def with_inertia(found: Clusters) -> DataFrame:
    """Adds each cluster's and the whole table's sum of distances, and a hash of the cluster's centroid.

    The join is with one row per cluster, k rows at most.
    """
    spark = found.assigned.sparkSession
    sums = found.assigned.groupBy("cluster").agg(_exact_sum("distance").alias("s")).collect()  # k rows at most
    total = sum(row["s"] for row in sums)
    cells = [",".join(map(str, found.centroids[row["cluster"]].tolist())) for row in sums]
    per_cluster = spark.createDataFrame(
        [(row["cluster"], row["s"], total, text) for row, text in zip(sums, cells, strict=True)],
        "cluster int, cluster_inertia bigint, inertia bigint, cells string",
    ).withColumn("centroid_sha256", F.sha2("cells", 256)).drop("cells")
    return found.assigned.join(F.broadcast(per_cluster), "cluster")


def _exact_sum(column: str) -> Column:
    return F.sum(F.col(column).cast("decimal(38,0)")).cast("bigint")
