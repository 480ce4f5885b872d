"""Near-duplicate documents by fast similarity sketching, banding and exact verification.

A document's set holds the hashes of its distinct word shingles. Its sketch follows fast similarity
sketching (Dahlgaard, Knudsen, Thorup, FOCS 2017): in round i every element falls into a hashed
bin with the value i plus a hashed fraction, and a bin keeps its smallest value. The first t rounds
place elements at random, the next t rounds fill bin i - t, so every coordinate is filled, after
O(n + t log t) steps; two sketches agree in a coordinate with a chance of their Jaccard similarity
and the agreement concentrates as with t independent hash functions.

Documents with equal sets are one class from the start. Classes that agree in all rows of a band
are candidates. With 32 bands of 4 rows a pair at similarity 0.8 is missed with a chance of 5e-8.

Candidates are verified on full sets without listing all pairs of a bucket. First every member is
compared with the bucket's smallest one, and connected components are taken. Buckets whose members
are all connected are finished. In the others every pair of different components is compared, in
blocks of a bounded number of members, each block pair in a task group of its own.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from spendspark.llm import textscan
from spendspark.llm.components import components
from spendspark.session import materialise

cloudpickle.register_pickle_by_value(sys.modules[__name__])

BANDS, ROWS = 32, 4
# Members of a block in the second comparison.
BLOCK = 512
EMPTY = np.uint64(0xFFFFFFFFFFFFFFFF)


def sketch(docs: np.ndarray, values: np.ndarray, n_docs: int, t: int) -> np.ndarray:
    """(n_docs, t) sketches of the sets given as distinct (document, value); t is a power of two."""
    out = np.full(n_docs * t, EMPTY, dtype=np.uint64)
    seeds = textscan.constants(2 * t, 37)
    base = docs * t
    for i in range(2 * t):
        if not len(values):
            break
        z = textscan.mix(values ^ seeds[i])
        place = base + (z & np.uint64(t - 1)).astype(np.int64) if i < t else base + (i - t)
        np.minimum.at(out, place, (z >> np.uint64(32)) | np.uint64(i << 32))
        full = (out.reshape(n_docs, t) != EMPTY).all(axis=1)
        open_ = ~full[base // t]
        if not open_.all():
            base, values = base[open_], values[open_]
    return out.reshape(n_docs, t)


def band_keys(sketches: np.ndarray, bands: int, rows: int) -> np.ndarray:
    """(n_docs, bands) keys; the band's number is part of its key."""
    parts = sketches.reshape(len(sketches), bands, rows)
    key = np.zeros(parts.shape[:2], dtype=np.uint64) + textscan.constants(bands, 41)[None, :]
    for r, factor in enumerate(textscan.constants(rows, 43)):
        key += textscan.mix(parts[:, :, r] + factor)
        key = textscan.mix(key)
    return key


def _sets(text: pa.Array, lo: int, hi: int, data, offsets, k: int):
    at = offsets[lo : hi + 1]
    runs = textscan.Runs(data[at[0] : at[-1]], at - at[0], ~textscan.IS_SPACE)
    return textscan.distinct(*textscan.shingles(runs, runs.strong_hashes(), k))


def _sketch_task(k: int, bands: int, rows: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = textscan.text_bytes(batch.column(1))
            for lo, hi in textscan.slices(offsets):
                docs, values = _sets(batch.column(1), lo, hi, data, offsets, k)
                n = hi - lo
                size = np.bincount(docs, minlength=n)
                signature = []
                for seed in textscan.constants(2, 47):
                    total = np.zeros(len(values) + 1, dtype=np.uint64)
                    np.cumsum(textscan.mix(values + seed), out=total[1:])
                    ends = np.append(0, np.cumsum(size))
                    signature.append((total[ends[1:]] - total[ends[:-1]]).view(np.int64))
                keys = band_keys(sketch(docs, values, n, bands * rows), bands, rows).view(np.int64)
                lists = pa.ListArray.from_arrays(
                    pa.array(np.arange(0, n * bands + 1, bands, dtype=np.int32)), pa.array(keys.reshape(-1))
                )
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(lo, n), pa.array(size), *map(pa.array, signature), lists],
                    ["id", "n", "s1", "s2", "keys"],
                )

    return run


def _set_task(k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = textscan.text_bytes(batch.column(1))
            for lo, hi in textscan.slices(offsets):
                docs, values = _sets(batch.column(1), lo, hi, data, offsets, k)
                ends = np.append(0, np.cumsum(np.bincount(docs, minlength=hi - lo))).astype(np.int32)
                lists = pa.ListArray.from_arrays(pa.array(ends), pa.array(values.view(np.int64)))
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(lo, hi - lo), lists], ["id", "items"])

    return run


def _link_task(percent: int):
    def run(key: tuple, members: pd.DataFrame) -> pd.DataFrame:
        """Links between different components of one pair of blocks, enough to connect what is linked."""
        first, second = int(key[1]), int(key[2])
        ids, block = members["id"].to_numpy(), members["block"].to_numpy()
        component = pd.factorize(members["component"])[0]
        size = members["items"].map(len).to_numpy()
        dense = np.unique(np.concatenate(members["items"].to_numpy()), return_inverse=True)[1]
        starts = np.append(0, np.cumsum(size)[:-1])
        flags = np.zeros(dense.max() + 1, dtype=np.int32)
        found = []
        for i in np.flatnonzero(block == first):
            others = component != component[i]
            others &= (block == second) if first != second else (np.arange(len(ids)) > i)
            if not others.any():
                continue
            own = dense[starts[i] : starts[i] + size[i]]
            flags[own] = 1
            shared = np.add.reduceat(flags[dense], starts)
            flags[own] = 0
            linked = others & (100 * shared >= percent * (size + size[i] - shared))
            for j in np.flatnonzero(linked):
                if component[j] != component[i]:
                    found.append((ids[i], ids[j]))
                    component[component == component[j]] = component[i]
        return pd.DataFrame(found, columns=["a", "b"], dtype="int64")

    return run


def near_duplicates(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = 5, percent: int = 80
) -> DataFrame:
    """(id, n_shingles, component_id, kept) per row: which documents are near copies of each other.

    Words are runs without space, tab or line breaks, A-Z lower-cased; a text with fewer than ``k``
    words is one shingle. Documents link if 100 * shared >= percent * united shingles. component_id is
    the smallest id reachable by links; ``kept`` marks the one document of each component.

    Null or blank texts have an empty set and link with nothing. A row without an id links with
    nothing, has no component and is kept. Rows that share an id each follow their own text; a text
    without words keeps its row's id.
    Whole texts are used, whatever their length; an empty table gives an empty result. Other columns
    are not read.
    """
    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    id_type = texts.schema["id"].dataType.simpleString()
    sketches = materialise(
        texts.mapInArrow(
            _sketch_task(k, BANDS, ROWS), f"id {id_type}, n bigint, s1 bigint, s2 bigint, keys array<bigint>"
        ),
        "sketches",
    )
    same = ["n", "s1", "s2"]
    classes = materialise(
        sketches.where("n > 0 and id is not null").groupBy(*same).agg(F.min("id").alias("rep"), F.any_value("keys").alias("keys")),
        "classes",
    )
    joined = _linked_classes(texts, classes, k, percent, id_type)
    by_class = classes.select(*same, "rep").join(joined, F.col("rep") == F.col("node"), "left").select(
        *same, F.coalesce("component", "rep").alias("component")
    )
    out = sketches.select("id", *same).join(by_class, same, "left")
    component = F.when(F.col("id").isNotNull(), F.coalesce("component", "id"))
    return out.select(
        F.col("id").alias(id_col),
        F.col("n").alias("n_shingles"),
        component.alias("component_id"),
        F.coalesce(component == F.col("id"), F.lit(True)).alias("kept"),
    )


def _linked_classes(texts: DataFrame, classes: DataFrame, k: int, percent: int, id_type: str) -> DataFrame:
    """(node, component) of the classes that are linked to another class."""
    members = classes.select("rep", F.explode("keys").alias("key"))
    buckets = members.groupBy("key").agg(F.min("rep").alias("center"), F.count("*").alias("size")).where("size > 1")
    candidates = materialise(members.join(buckets, "key"), "candidates")
    # Set sizes bound the similarity, so pairs of very different sizes are not verified.
    pairs = candidates.where("rep <> center").select("rep", "center").distinct()
    active = candidates.select(F.col("rep").alias("id")).distinct()
    sets = materialise(
        texts.join(active, "id", "left_semi")
        .mapInArrow(_set_task(k), f"id {id_type}, items array<bigint>")
        # A row that shares its id with another one may have an empty set.
        .where(F.size("items") > 0),
        "sets",
    )
    links = materialise(_verified(pairs, sets, percent), "verified")
    first = components(links)
    first = materialise(first, "first-components")
    # Second comparison: buckets that hold more than one component.
    marked = candidates.join(first, F.col("rep") == F.col("node"), "left").select(
        "key", "rep", "size", F.coalesce("component", "rep").alias("component")
    )
    mixed = marked.groupBy("key", "size").agg(
        F.min("component").alias("low"), F.max("component").alias("high"),
        F.sum(F.xxhash64("rep").cast("decimal(20,0)")).alias("content"),
    ).where("low <> high")
    # Buckets with the same members are compared once.
    mixed = mixed.groupBy("size", "content").agg(F.min("key").alias("key")).select("key", "size")
    # A bucket of two has been compared by its smallest member already.
    open_ = marked.join(mixed.where("size > 2").select("key"), "key", "left_semi")
    blocks = F.ceil(F.col("size") / F.lit(BLOCK)).cast("int")
    placed = open_.withColumn("blocks", blocks).withColumn("block", F.pmod(F.xxhash64("rep"), F.col("blocks")).cast("int"))
    spread = placed.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).select(
        "key", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"),
        F.col("rep").alias("id"), "block", "component",
    )
    more = materialise(
        spread.join(sets, "id").groupBy("key", "i", "j").applyInPandas(_link_task(percent), "a bigint, b bigint"), "more-links"
    )
    root = first.select(F.col("node"), "component")
    ends = (
        more.join(root.toDF("a", "ca"), "a", "left")
        .join(root.toDF("b", "cb"), "b", "left")
        .select(F.coalesce("ca", "a").alias("a"), F.coalesce("cb", "b").alias("b"))
    )
    second = materialise(components(ends), "second-components")
    every = first.select("node").union(second.select("node")).distinct()
    merged = every.join(first, "node", "left").withColumnRenamed("component", "c1")
    step = second.toDF("c1", "c2")
    return merged.withColumn("c1", F.coalesce("c1", "node")).join(step, "c1", "left").select(
        "node", F.coalesce("c2", "c1").alias("component")
    )


def _verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    left = sets.select(F.col("id").alias("rep"), F.col("items").alias("x"))
    right = sets.select(F.col("id").alias("center"), F.col("items").alias("y"))
    shared: Column = F.size(F.array_intersect("x", "y"))
    united = F.size("x") + F.size("y") - shared
    possible = 100 * F.least(F.size("x"), F.size("y")) >= percent * F.greatest(F.size("x"), F.size("y"))
    both = pairs.join(left, "rep").join(right, "center").where(possible)
    return both.where(100 * shared >= percent * united).select(F.col("rep").alias("a"), F.col("center").alias("b"))
