"""Near-duplicate embeddings by an exact metric range join.

Cosine >= c between vectors is a distance of at most r = sqrt(2 - 2c) between their directions. A
bounded number of pivots cuts space into cells, a vector's home being its nearest pivot. By the
triangle inequality a vector within r of some member of cell A is at most 2r farther from A's pivot
than from its own; it is copied into every such cell, and no other cell needs it. Directions lie in
Euclidean space, where the distance to the plane between two pivots gives a sharper bound of the
same kind, so a copy is made only if both bounds allow it. Cells then join on their own: each home
vector meets all vectors of its cell that can be near it, once.

Equal vectors are one class with a weight. A cell is cut into blocks of bounded size and a task
group compares two blocks as one matrix product. It returns the number of links per vector and
enough links to connect what is linked, never a list of pairs.
"""

from __future__ import annotations

import math
import sys

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from spendspark.llm.components import components
from spendspark.session import materialise

cloudpickle.register_pickle_by_value(sys.modules[__name__])

PIVOTS = 16
# Vectors that pivots are picked from, and vectors of a block.
PIVOT_SAMPLE = 1_024
BLOCK = 1_024
# Room for rounding in the bounds, which only ever adds copies.
SLACK = 1e-6


def usable(vector: Column) -> Column:
    """Not null or empty, all components finite, and not the zero vector."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return vector.isNotNull() & finite & F.exists(vector, lambda x: x != 0)


def unit(rows: np.ndarray) -> np.ndarray:
    """Directions; the largest component is scaled to 1 first, so that squares stay in range."""
    rows = rows / np.abs(rows).max(axis=1, keepdims=True)
    return rows / np.sqrt((rows * rows).sum(axis=1, keepdims=True))


def spread_pivots(sample: np.ndarray, n: int) -> np.ndarray:
    """Up to n vectors of the sample, each as far as possible from those before."""
    chosen = [0]
    far = ((sample - sample[0]) ** 2).sum(axis=1)
    while len(chosen) < n and far.max() > 1e-12:
        chosen.append(int(far.argmax()))
        far = np.minimum(far, ((sample - sample[chosen[-1]]) ** 2).sum(axis=1))
    return sample[chosen]


def cells(directions: np.ndarray, pivots: np.ndarray, radius: float) -> tuple[np.ndarray, np.ndarray]:
    """Home cell of each vector, and which cells need a copy of it (its home included)."""
    squared = np.maximum(2.0 - 2.0 * directions @ pivots.T, 0.0)
    distance = np.sqrt(squared)
    home = distance.argmin(axis=1)
    rows = np.arange(len(home))
    own, own_squared = distance[rows, home][:, None], squared[rows, home][:, None]
    between = np.sqrt(((pivots[home][:, None, :] - pivots[None, :, :]) ** 2).sum(axis=2))
    triangle = distance <= own + 2 * radius + SLACK
    plane = squared - own_squared <= 2 * radius * between + SLACK
    return home, triangle & plane


def _cell_task(pivots_of, radius: float):
    def run(batches):
        for rows in batches:
            homes = np.zeros(len(rows), dtype=np.int32)
            targets: list = [None] * len(rows)
            for dim, part in rows.groupby("dim", sort=False):
                at = rows.index.get_indexer(part.index)
                directions = unit(np.stack(part["vector"].to_numpy()).astype(np.float64))
                # A length beyond the most frequent ones has a single cell.
                pivots = pivots_of.value.get(int(dim), np.eye(1, int(dim)))
                home, needed = cells(directions, pivots, radius)
                homes[at] = home
                for k, i in enumerate(at):
                    targets[i] = np.flatnonzero(needed[k]).astype(np.int32)
            yield rows.assign(home=homes, targets=targets)

    return run


def _block_task(threshold: float):
    def run(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        """Links of the home vectors of one block with the vectors of another one of the same cell."""
        is_home = rows["as_home"].to_numpy()
        left, right = rows[is_home], rows[~is_home]
        empty = pd.DataFrame({"a": [], "b": [], "links": []}).astype("int64")
        if left.empty or right.empty:
            return empty
        x, y = (unit(np.stack(p["vector"].to_numpy()).astype(np.float64)) for p in (left, right))
        a, b = left["id"].to_numpy(), right["id"].to_numpy()
        linked = (x @ y.T >= threshold) & (a[:, None] != b[None, :])
        count = (linked * right["weight"].to_numpy()[None, :]).sum(axis=1)
        # Smallest linked id, passed on until nothing changes, connects what the matrix links.
        most = np.iinfo(np.int64).max
        some_a, some_b = linked.any(axis=1), linked.any(axis=0)
        part = linked[np.ix_(some_a, some_b)]
        ra, rb = a[some_a], b[some_b]
        while part.size:
            na = np.minimum(ra, np.where(part, rb[None, :], most).min(axis=1))
            nb = np.minimum(rb, np.where(part, na[:, None], most).min(axis=0))
            if (na == ra).all() and (nb == rb).all():
                break
            ra, rb = na, nb
        return pd.concat(
            [
                pd.DataFrame({"a": a[some_a], "b": ra, "links": count[some_a]}),
                pd.DataFrame({"a": b[some_b], "b": rb, "links": 0}),
            ]
        ).astype("int64")

    return run


def near_vectors(
    rows: DataFrame, threshold: float = 0.98, id_col: str = "vec_id", vector_col: str = "embedding",
    group_col: str | None = "label", pivots: int = PIVOTS,
) -> DataFrame:
    """(id, n_links, component_id, kept) per row: vectors with a cosine of at least ``threshold``.

    Only vectors of the same, non-null group and the same length are compared, in double precision.
    n_links counts other rows that are linked directly; component_id is the smallest id reachable
    by links; ``kept`` marks the row that has it. Null, empty or zero vectors and those with a null
    or non-finite component link with nothing. So does a row without an id: it has no component and
    is kept. Rows that share an id and a vector count as several links to each other. An empty
    table gives an empty result. Other columns are not read.
    """
    spark = rows.sparkSession
    group = F.col(group_col) if group_col else F.lit(0)
    own = rows.select(F.col(id_col).alias("id"), F.col(vector_col).alias("vector"), group.alias("grp"))
    good = own.where(F.col("id").isNotNull() & F.col("grp").isNotNull() & usable(F.col("vector")))
    # -0.0 and 0.0 are the same component.
    good = good.withColumn("vector", F.transform("vector", lambda x: x + F.lit(0.0).cast("float")))
    member = good.select("id", "grp", F.hash("vector").alias("h1"), F.xxhash64("vector").alias("h2"))
    classes = materialise(
        good.groupBy("grp", F.hash("vector").alias("h1"), F.xxhash64("vector").alias("h2"), "vector")
        .agg(F.min("id").alias("rep"), F.count("*").alias("weight"))
        .withColumn("dim", F.size("vector")),
        "vector-classes",
    )
    dims = [r["dim"] for r in classes.groupBy("dim").count().orderBy(F.desc("count"), "dim").limit(64).collect()]
    chosen = {}
    for dim in dims:
        sample = classes.where(F.col("dim") == dim).orderBy("h2", "h1").limit(PIVOT_SAMPLE).select("vector").toPandas()
        chosen[dim] = spread_pivots(unit(np.stack(sample["vector"].to_numpy()).astype(np.float64)), pivots)
    sent = spark.sparkContext.broadcast(chosen)
    radius = math.sqrt(2.0 - 2.0 * threshold)
    kind = classes.schema["grp"].dataType.simpleString()
    vector_kind = classes.schema["vector"].dataType.simpleString()
    placed = materialise(
        classes.select("rep", "weight", "dim", "grp", "vector").mapInPandas(
            _cell_task(sent, radius),
            f"rep bigint, weight bigint, dim int, grp {kind}, vector {vector_kind}, home int, targets array<int>",
        ),
        "cells",
    )
    cell = ["grp", "dim", "cell"]
    copies = placed.select("rep", "weight", "grp", "dim", "vector", "home", F.explode("targets").alias("cell"))
    sizes = materialise(
        copies.groupBy(*cell).agg(F.count("*").alias("members"), F.count_if(F.col("home") == F.col("cell")).alias("homes")),
        "cell-sizes",
    )
    blocks = lambda n: F.ceil(F.col(n) / F.lit(BLOCK)).cast("int")
    sized = copies.join(sizes.select(*cell, blocks("homes").alias("hb"), blocks("members").alias("mb")), cell)
    slot = F.xxhash64(F.lit(3), "rep")
    each = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    keep = ["grp", "dim", "cell", "i", "j", F.col("rep").alias("id"), "weight", "vector"]
    homes = sized.where("home = cell").withColumn("i", F.pmod(slot, "hb").cast("int")).withColumn("j", each("mb"))
    others = sized.where("hb > 0").withColumn("j", F.pmod(slot, "mb").cast("int")).withColumn("i", each("hb"))
    meeting = homes.select(*keep, F.lit(True).alias("as_home")).union(others.select(*keep, F.lit(False).alias("as_home")))
    found = materialise(
        meeting.groupBy("grp", "dim", "cell", "i", "j").applyInPandas(_block_task(threshold), "a bigint, b bigint, links bigint"),
        "vector-links",
    )
    linked = found.groupBy("a").agg(F.sum("links").alias("links"))
    joined = materialise(components(found.select("a", "b")), "vector-components")
    per_class = (
        classes.select("grp", "h1", "h2", "rep", "weight")
        .join(linked, F.col("rep") == F.col("a"), "left")
        .join(joined, F.col("rep") == F.col("node"), "left")
        .select("grp", "h1", "h2", (F.coalesce("links", F.lit(0)) + F.col("weight") - 1).alias("n_links"),
                F.coalesce("component", "rep").alias("component"))
    )
    # A row finds its class by its group and two hashes of its vector.
    by_row = member.join(per_class, ["grp", "h1", "h2"]).select("id", "n_links", "component")
    alone = own.where(~F.coalesce(F.col("id").isNotNull() & F.col("grp").isNotNull() & usable(F.col("vector")), F.lit(False)))
    every = by_row.union(alone.select("id", F.lit(0).cast("bigint"), "id"))
    return every.select(
        F.col("id").alias(id_col),
        "n_links",
        F.col("component").alias("component_id"),
        F.coalesce(F.col("component") == F.col("id"), F.lit(True)).alias("kept"),
    )
