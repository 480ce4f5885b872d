"""Token ids in ORC files: stripes with integer run-length encoding, row indexes and Bloom filters.

Documents are dealt out by ranges of their id and sorted within each, so files hold ascending,
disjoint id ranges. Each task encodes its documents in that order and counts ids as it goes; the
position of a document in the whole corpus is the count within its file plus the ids of all
earlier files, whose totals are one row per file. ORC writes the ids as run-length encoded
integers, keeps minima and maxima of document ids for files, stripes and row groups, and a Bloom
filter on them per row group; a reader skips what cannot hold the documents it asks for, and
stripes are read by different tasks.
"""

from __future__ import annotations

import sys
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from spendspark.llm import tokens

cloudpickle.register_pickle_by_value(sys.modules[__name__])

ORC_OPTIONS = {
    "compression": "zstd",
    "orc.stripe.size": str(32 << 20),
    "orc.row.index.stride": "1000",
    "orc.create.index": "true",
    "orc.bloom.filter.columns": "doc_id",
    "orc.bloom.filter.fpp": "0.01",
}
SCHEMA = "doc_id {id}, part int, row_in_part bigint, start_in_part bigint, n_tokens bigint, ids array<int>"


def _encode_task(path: str, end_id: int):
    end = np.array([end_id], dtype="<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, start, row = tokens.encoder(path), 0, 0
        for batch in batches:
            done: list[bytes] = []
            first = held = 0
            for i, ids in tokens.encoded(batch.column(1), encode):
                done.append(ids + end)
                held += len(done[-1])
                if held >= 8 << 20 or i == batch.num_rows - 1:
                    lengths = np.array([len(x) // 4 for x in done], dtype=np.int64)
                    ends = np.append(0, np.cumsum(lengths))
                    values = np.frombuffer(b"".join(done), dtype="<i4")
                    yield pa.RecordBatch.from_arrays(
                        [
                            batch.column(0).slice(first, len(done)),
                            pa.array(np.arange(row, row + len(done))),
                            pa.array(start + ends[:-1]),
                            pa.array(lengths),
                            pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), pa.array(values)),
                        ],
                        ["doc_id", "row_in_part", "start_in_part", "n_tokens", "ids"],
                    )
                    start, row, first = start + int(ends[-1]), row + len(done), i + 1
                    done, held = [], 0

    return run


def write_token_files(
    docs: DataFrame,
    path: str,
    tokenizer_path: str,
    end_id: int,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> None:
    """Encode every text, append ``end_id`` and write the ids to ORC files in ascending id order.

    A null text counts as empty and has the end id only. Rows that share an id stay next to each
    other, in the order of their texts. Rows without an id come first. Other columns are not read.
    """
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    partitions = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ordered = rows.repartitionByRange(partitions, "doc_id").sortWithinPartitions("doc_id", "text")
    made = ordered.mapInArrow(
        _encode_task(tokenizer_path, end_id),
        f"doc_id {kind}, row_in_part bigint, start_in_part bigint, n_tokens bigint, ids array<int>",
    ).withColumn("part", F.spark_partition_id())
    made.select("doc_id", "part", "row_in_part", "start_in_part", "n_tokens", "ids").write.options(**ORC_OPTIONS).orc(path)


def read_token_files(spark: SparkSession, path: str, where: Column | None = None, id_type: str = "bigint") -> DataFrame:
    """The stored documents; a condition on doc_id is answered from indexes and Bloom filters."""
    stored = spark.read.schema(SCHEMA.format(id=id_type)).orc(path)
    return stored if where is None else stored.where(where)


def with_positions(stored: DataFrame) -> DataFrame:
    """Adds ``start``: the ids of all documents before each one.

    The totals of the files are one short row per file; only these meet in one task. Leave out the
    ids themselves before, since rows may be shuffled to meet the totals.
    """
    totals = stored.groupBy("part").agg(F.sum("n_tokens").alias("ids_in_part"))
    before = W.orderBy("part").rowsBetween(W.unboundedPreceding, -1)
    offsets = totals.select("part", F.coalesce(F.sum("ids_in_part").over(before), F.lit(0)).alias("part_start"))
    return stored.join(offsets, "part").withColumn("start", F.col("part_start") + F.col("start_in_part"))


def ids_crc32(column: str) -> Column:
    """CRC-32 of the ids as little-endian unsigned 32-bit integers."""

    @F.arrow_udf("bigint")
    def crc(ids: pa.Array) -> pa.Array:
        flat, at = ids.values.to_numpy(zero_copy_only=False).astype("<i4", copy=False), ids.offsets.to_numpy()
        raw = memoryview(np.ascontiguousarray(flat)).cast("B")
        return pa.array([zlib.crc32(raw[4 * a : 4 * b]) for a, b in zip(at[:-1], at[1:], strict=True)], pa.int64())

    return crc(F.col(column))
