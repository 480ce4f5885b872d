"""Samples of a fixed number of rows by hash, for fits on a bounded part of the labelled rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

HASH_RANGE = 1 << 62


def smallest_hashes(rows: DataFrame, n: int, draw: Column, *then: str) -> DataFrame:
    """The n rows with the smallest hash ``draw``, ties in the order of ``then``.

    The rows are counted, and those whose hash is far above any that can win are left out before they are
    ordered; so about 1.2 n rows are brought together, whatever the number of rows and partitions. If
    repeated hashes leave too few, the bound is doubled. ``rows`` should be cheap to read again.
    """
    place = F.pmod(draw, F.lit(HASH_RANGE))
    total = rows.count()
    share = min(1.0, 1.2 * n / max(total, 1))
    near = rows if share == 1.0 else rows.where(place < int(share * HASH_RANGE))
    while share < 1.0 and near.count() < n:
        share = min(1.0, 2 * share)
        near = rows if share == 1.0 else rows.where(place < int(share * HASH_RANGE))
    return near.orderBy(place, *then).limit(n)
