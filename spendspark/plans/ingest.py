"""Landed records to the current snapshot of normalised transactions."""

from __future__ import annotations

import os
from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from spendspark.operators.clean import judged
from spendspark.schemas import TRANSACTIONS
from spendspark.session import materialise
from spendspark.sources import transactions


def ingest_job(
    spark: SparkSession,
    read: Callable[[], DataFrame],
    root: str,
    demo: Callable[[], DataFrame] | None = None,
    date_format: str | None = None,
) -> str | None:
    """Publish the batch that ``read`` returns; an empty or missing one keeps the last snapshot.

    Rows that cannot be used are added to the folder ``rejected`` below the root, with the reason.

    With nothing published so far a missing batch is an error, unless the caller gives demo data.
    """
    try:
        batch = read()
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        current = transactions.current_snapshot(spark, root)
        if current is None and demo is None:
            raise
        return current or transactions.publish_snapshot(demo(), root)
    rows = materialise(judged(batch, date_format), "landed")
    bad = rows.where(F.col("error").isNotNull())
    if not bad.isEmpty():
        bad.write.mode("append").parquet(os.path.join(root, "rejected"))
    return transactions.publish_snapshot(rows.where(F.col("error").isNull()).select(*TRANSACTIONS.names), root)
