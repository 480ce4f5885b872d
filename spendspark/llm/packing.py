"""Best-fit packing of documents into sequences of a fixed length, by hierarchical residual packing.

Texts become short rows first: one per piece of at most ``capacity`` tokens. Each partition of
pieces is packed by best fit, largest first. Bins that are nearly full are sequences. The others go
on as items of their own size: a tree of rounds gathers the underfull bins of several groups and
packs them again by best fit, so that what is left open shrinks as groups merge. The number of
items in one group is bounded in every round.
"""

from __future__ import annotations

import sys
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spendspark.llm import tokens
from spendspark.session import materialise

cloudpickle.register_pickle_by_value(sys.modules[__name__])

CAPACITY = 4096
# Items that one group packs, on average.
GROUP_ITEMS = 50_000
# Groups merged into one by a round.
FAN_IN = 8
# Rounds go on while they bring the groups down to this share.
MOST_LEFT = 0.75
# A bin with at most this share of its capacity free is final.
FREE_SHARE = 0.002


def best_fit(sizes: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """Bin and offset of every item, largest items first, each into the fullest bin that takes it.

    Open bins are stacks by free space; the bits of ``free`` mark the stacks that hold any, so the
    best fit is the lowest marked bit at or above the item's size.
    """
    stacks: list[list[int]] = [[] for _ in range(capacity + 1)]
    free = bins = 0
    bin_of, offset = np.empty(len(sizes), dtype=np.int64), np.empty(len(sizes), dtype=np.int64)
    for item in np.argsort(-sizes, kind="stable"):
        size = int(sizes[item])
        fitting = free >> size
        if fitting:
            space = size + (fitting & -fitting).bit_length() - 1
            stack = stacks[space]
            chosen = stack.pop()
            if not stack:
                free ^= 1 << space
        else:
            space, chosen, bins = capacity, bins, bins + 1
        bin_of[item], offset[item] = chosen, capacity - space
        left = space - size
        if left:
            stacks[left].append(chosen)
            free |= 1 << left
    return bin_of, offset


def _piece_task(path: str, end_id: int, capacity: int):
    end, width = np.array([end_id], dtype="<u4").tobytes(), 4 * capacity

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = tokens.encoder(path)
        for batch in batches:
            row, piece, length, crc = [], [], [], []
            for i, ids in tokens.encoded(batch.column(1), encode):
                ids += end
                for at in range(0, len(ids), width):
                    part = ids[at : at + width]
                    row.append(i)
                    piece.append(at // width)
                    length.append(len(part) // 4)
                    crc.append(zlib.crc32(part))
            numbers = [np.array(x, dtype=np.int64) for x in (piece, length, crc)]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).take(pa.array(row, pa.int64())),
                    pa.array(numbers[0].astype(np.int32)),
                    pa.array(numbers[0] * capacity),
                    pa.array(numbers[1]),
                    pa.array(numbers[2]),
                ],
                ["doc_id", "piece", "start", "length", "ids_crc32"],
            )

    return run


def pieces(
    docs: DataFrame,
    tokenizer_path: str,
    end_id: int,
    capacity: int = CAPACITY,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """One row per piece of a document: doc_id, piece, start, length, ids_crc32."""
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(
        _piece_task(tokenizer_path, end_id, capacity),
        f"doc_id {kind}, piece int, start bigint, length bigint, ids_crc32 bigint",
    )


def _round_task(capacity: int, level: int):
    def run(key: tuple, items: pd.DataFrame) -> pd.DataFrame:
        items = items.sort_values(["size", "item"], ascending=[False, True], kind="stable")
        bins, offset = best_fit(items["size"].to_numpy(), capacity)
        fill = np.bincount(bins, weights=items["size"].to_numpy()).astype(np.int64)
        return pd.DataFrame(
            {
                "item": items["item"].to_numpy(),
                "bin": (np.int64(level) << 56) | (np.int64(key[0]) << 32) | bins,
                "shift": offset,
                "fill": fill[bins],
                "group": np.int64(key[0]),
            }
        )

    return run


def pack(items: DataFrame, capacity: int = CAPACITY, group_items: int = GROUP_ITEMS, fan_in: int = FAN_IN) -> DataFrame:
    """Adds sequence_id and offset to rows with a ``length`` of 1 to ``capacity`` and a unique ``item``.

    ``items`` is read several times and must be stored. Ties are broken by item, so the packing
    depends on the rows only. An empty table gives an empty result.
    """
    n = items.count()
    groups = max(1, -(-n // group_items))
    open_ = items.select("item", F.col("length").alias("size"), F.pmod(F.xxhash64("item"), F.lit(groups)).alias("group"))
    nearly_full = capacity - int(capacity * FREE_SHARE)
    where = None  # item, sequence_id, offset so far
    level = 0
    while True:
        packed = materialise(
            open_.groupBy("group").applyInPandas(
                _round_task(capacity, level), "item bigint, bin bigint, shift bigint, fill bigint, `group` bigint"
            ),
            "packed",
        )
        step = packed.select("item", "bin", "shift")
        if where is None:
            where = step.toDF("item", "sequence_id", "offset")
        else:
            moved = where.join(step.toDF("sequence_id", "bin", "shift"), "sequence_id", "left")
            where = materialise(
                moved.select(
                    "item", F.coalesce("bin", "sequence_id").alias("sequence_id"),
                    (F.col("offset") + F.coalesce("shift", F.lit(0))).alias("offset"),
                ),
                "placed",
            )
        if groups == 1:
            break
        underfull = packed.where(F.col("fill") < nearly_full).groupBy("bin", "group").agg(F.first("fill").alias("size"))
        underfull = materialise(underfull, "underfull")
        left = underfull.count()
        # As many groups as keep each within its bound. Items that hardly became fewer are too large
        # to meet in a bin, and then a wider group would not fit them better.
        fewer = max(-(-groups // fan_in), -(-left // group_items))
        if not left or fewer > MOST_LEFT * groups:
            break
        groups = fewer
        open_ = underfull.select(F.col("bin").alias("item"), "size", F.pmod("group", F.lit(groups)).alias("group"))
        level += 1
    return items.join(where, "item")


def pack_documents(
    docs: DataFrame, tokenizer_path: str, end_id: int, capacity: int = CAPACITY,
    id_col: str = "doc_id", text_col: str = "text", group_items: int = GROUP_ITEMS, fan_in: int = FAN_IN,
) -> DataFrame:
    """Pieces of all documents with the sequence and the offset each is placed at.

    Columns: doc_id, piece, start, length, ids_crc32, sequence_id, offset. Only documents longer
    than ``capacity`` are cut. A null or empty text is one piece with the end id. Rows that share an
    id, or have none, are packed each on their own. An empty table gives an empty result. Other columns
    are not read.
    """
    rows = pieces(docs, tokenizer_path, end_id, capacity, id_col, text_col)
    stored = materialise(rows.withColumn("item", F.monotonically_increasing_id()), "pieces")
    return pack(stored, capacity, group_items, fan_in).drop("item")
