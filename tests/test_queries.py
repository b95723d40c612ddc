"""Every registered driver query against its DuckDB oracle (the driver's correctness gate)."""

import os

import pytest

import __spark_entry__ as E
from tests.oracle import compare, duck
from trackyard.plans.analogues import QUERIES
from trackyard.plans.ingest_queries import INGEST_QUERIES
from trackyard.plans.table_queries import LINE_NUMBER, TABLE_QUERIES

SF = os.environ.get("TRACKYARD_TEST_SF", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="driver test tables not available")


@pytest.fixture(scope="module")
def con():
    return duck(SF)


# the training-data queries, where they are registered, have tests of their own
WAREHOUSE = sorted(QUERIES | TABLE_QUERIES | INGEST_QUERIES)


def test_every_query_has_an_oracle():
    assert set(WAREHOUSE) <= set(E.queries()) and set(WAREHOUSE) <= set(E.oracle_sql())


@pytest.mark.parametrize("name", WAREHOUSE)
def test_query_matches_oracle(spark, con, name):
    df = E.queries()[name](spark, SF)
    ok, msg = compare(df, con, E.oracle_sql()[name])
    assert ok, msg


LARGER = SF.replace("sf0.001", "sf0.01")


@pytest.mark.parametrize("name", sorted(n for n in TABLE_QUERIES if n.startswith("silver_")))
def test_latest_rows_where_keys_repeat(spark, name):
    """At this size keys of different rows tie unless the order is total."""
    ok, msg = compare(E.queries()[name](spark, LARGER), duck(LARGER), E.oracle_sql()[name])
    assert ok, msg


@pytest.mark.parametrize(("table", "number"), [("lineitem", LINE_NUMBER), ("orders", "o_orderkey"), ("events", "event_id")])
def test_row_numbers_are_unique(spark, table, number):
    """Files and row numbers order the silver queries' rows; equal numbers would leave the latest row to chance."""
    rows = spark.read.parquet(f"{LARGER}/{table}.parquet").selectExpr(f"{number} AS n")
    assert rows.distinct().count() == rows.count()


def test_entry(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert df.columns == ["imsi", "start_time", "event_id", "stop_time", "call_setup_duration_ms", "subscriber_key"]
