"""Every named query against the same query in DuckDB."""

import pytest

import __spark_entry__
from ontime_spark.plans.catalog import QUERIES
from ontime_spark.plans.oracle import ORACLE
from compare import connect, difference, type_difference

# A forest's bags are random, so only the shape of its results is checked.
ROWS_ONLY = {
    "rf_predictions",
    "rf_importance",
    "rf_metrics",
    "stream_scoring",
}


@pytest.fixture(scope="module")
def con(sf_dir):
    return connect(sf_dir)


def test_only_random_queries_lack_sql():
    assert set(QUERIES) - set(ORACLE) == ROWS_ONLY
    assert set(ORACLE) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_equals_sql(spark, con, sf_dir, name):
    frame = QUERIES[name](spark, sf_dir)
    assert difference(frame, con, ORACLE[name]) is None
    assert type_difference(frame, con, ORACLE[name]) is None
    assert not frame.isEmpty()


@pytest.mark.parametrize("name", sorted(ROWS_ONLY))
def test_gives_rows(spark, sf_dir, name):
    assert not QUERIES[name](spark, sf_dir).isEmpty()


def test_entry(spark):
    assert __spark_entry__.entry(spark).columns == [
        "carrier",
        "avg_delay",
        "total_flights",
        "cancellations",
    ]
