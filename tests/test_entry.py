"""Every registered query against its SQL counterpart on the smallest tables."""

import os

import duckdb
import pytest
from conftest import SMALL

import __spark_entry__ as registry


@pytest.fixture(scope="module")
def sql():
    connection = duckdb.connect()
    for name in os.listdir(SMALL):
        connection.execute(f"CREATE VIEW {name.split('.')[0]} AS SELECT * FROM '{SMALL}/{name}'")
    return connection


def plain(rows):
    """Rows as comparable text; whole numbers and floats of the same value look alike."""
    as_text = lambda v: repr(float(v)) if isinstance(v, (int, float)) and not isinstance(v, bool) else str(v)
    return sorted(tuple(map(as_text, row)) for row in rows)


def test_flagship(spark):
    assert registry.entry(spark).count() == 3584


def test_every_oracle_has_a_query():
    assert registry.oracle_sql().keys() <= registry.queries().keys()


@pytest.mark.parametrize("name", sorted(registry.oracle_sql()))
def test_query_equals_sql(spark, sql, name):
    got = registry.queries()[name](spark, SMALL)
    columns = sorted(got.columns)
    want = sql.sql(registry.oracle_sql()[name])
    assert sorted(want.columns) == columns
    wanted = want.select(*[f'"{c}"' for c in columns]).fetchall()
    assert plain(tuple(r) for r in got.select(columns).collect()) == plain(wanted)


@pytest.mark.parametrize("name", ["weekly_spend_gap_filled_events", "calendar_parts", "date_parsing", "monthly_training_features_orders"])
def test_days_do_not_move_with_the_session(spark, name):
    want = plain(registry.queries()[name](spark, SMALL).collect())
    before = spark.conf.get("spark.sql.session.timeZone")
    for zone in ("Asia/Tokyo", "America/Los_Angeles"):
        spark.conf.set("spark.sql.session.timeZone", zone)
        try:
            assert plain(registry.queries()[name](spark, SMALL).collect()) == want
            assert spark.conf.get("spark.sql.session.timeZone") == zone
        finally:
            spark.conf.set("spark.sql.session.timeZone", before)


@pytest.mark.parametrize("name", sorted(registry.queries().keys() - registry.oracle_sql().keys()))
def test_query_without_sql_has_rows(spark, name):
    assert not registry.queries()[name](spark, SMALL).isEmpty()
