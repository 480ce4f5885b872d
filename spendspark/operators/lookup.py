"""Joining a large table to a per-key table whose size is only known at run time."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Largest per-key table that is sent to every executor: about 16 MB at 2 columns.
BROADCAST_ROWS = 500_000
SALTS = 32


def left_lookup(
    facts: DataFrame,
    table: DataFrame,
    key: str,
    spread_by: list[str],
    broadcast_rows: int = BROADCAST_ROWS,
    salts: int = SALTS,
) -> DataFrame:
    """Left join on ``key`` without ever sending all rows of one key to one task.

    ``table`` must be stored (see ``session.materialise``): it is counted first, which for files
    reads their footers only. A small one is broadcast and the facts are not shuffled at all. A
    larger one is repeated once per salt, and the facts of a key spread over the salts by a hash
    of ``spread_by``.
    """
    if table.count() <= broadcast_rows:
        return facts.join(F.broadcast(table), key, "left")
    return _salted(facts, table, key, spread_by, salts)


def _salted(
    facts: DataFrame, table: DataFrame, key: str, spread_by: list[str], salts: int
) -> DataFrame:
    salt: Column = F.pmod(F.xxhash64(*spread_by), F.lit(salts)).cast("int")
    copies = table.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    return facts.withColumn("_salt", salt).join(copies, [key, "_salt"], "left").drop("_salt")
