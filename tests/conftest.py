from __future__ import annotations

import os
import sys
from datetime import date
from decimal import Decimal

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from spendspark.schemas import TRANSACTIONS  # noqa: E402
from spendspark.session import build_session  # noqa: E402

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session(
        "tests",
        "local[8]",
        **{
            "spark.sql.shuffle.partitions": "8",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.driver.memory": "4g",
            "spark.checkpoint.dir": str(tmp_path_factory.mktemp("shared")),
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def tx(spark):
    """Builds transactions from (user, category, amount, iso date) rows."""

    def build(*rows):
        return spark.createDataFrame(
            [
                (i, user, category, Decimal(str(amount)), date.fromisoformat(day), None)
                for i, (user, category, amount, day) in enumerate(rows)
            ],
            TRANSACTIONS,
        )

    return build


@pytest.fixture(scope="session")
def evaluate(spark):
    """The value of a column expression on one row of literals."""

    def value(column, **literals):
        from pyspark.sql import functions as F

        row = spark.range(1).select(*[F.lit(v).alias(k) for k, v in literals.items()])
        return row.select(column.alias("value")).first()["value"]

    return value


def rows_of(df, *order):
    """All rows as tuples, in the order of the given columns (or of all)."""
    return [tuple(r) for r in df.orderBy(*(order or df.columns)).collect()]
