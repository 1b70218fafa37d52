"""Every query against its SQL on the same tables; the rest by their row counts."""

from __future__ import annotations

import pytest

import __spark_entry__ as entry
from compare import connect, differences

QUERIES = entry.queries()
SQL = entry.oracle_sql()


@pytest.fixture(scope="module")
def con(small_dir):
    return connect(small_dir)


def test_sql_names_are_queries():
    assert set(SQL) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(SQL))
def test_equals_sql(spark, con, small_dir, name):
    assert differences(QUERIES[name](spark, small_dir), con, SQL[name]) == []


def test_entry(spark):
    assert entry.entry(spark).count() > 0


EXPECTED_ROWS = {
    "split_sizes": 2,
    "regression_metrics": 2,
    "feature_importance": 10,
}


@pytest.mark.parametrize("name", sorted(EXPECTED_ROWS))
def test_rows_of_model_queries(spark, small_dir, name):
    assert QUERIES[name](spark, small_dir).count() == EXPECTED_ROWS[name]


def test_fixture_counts_at_sf001(spark):
    """Row counts of the dirty variant written down in FIXTURES.md."""
    sf = "/root/testdata/sf0.01"
    rows = QUERIES["duplicate_rows"](spark, sf).first()
    assert (rows.total_rows, rows.distinct_rows) == (61_176, 60_000)
    assert QUERIES["bad_dates"](spark, sf).first()[0] == 597
    assert QUERIES["revenue_mismatch"](spark, sf).first()[0] == 1_326
    assert QUERIES["null_counts"](spark, sf).first().quantity == 650
    assert QUERIES["cleaning_report"](spark, sf).first().rows_after == 51_673
    assert QUERIES["kpi_totals"](spark, sf).first().total_profit == 2252395231.64
