"""Every registered query against DuckDB on the smallest tables."""

import pytest

import __spark_entry__ as entry
from tests.conftest import SMALL
from tests.harness import check
from tidemill.catalog import load_all

REGISTRY = load_all()


@pytest.mark.parametrize("name", sorted(REGISTRY))
def test_query_matches_sql(spark, con, name):
    problem, rows, _ = check(spark, con, REGISTRY[name], SMALL)
    assert problem is None


def test_entry_points(spark):
    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert entry.entry(spark).count() > 0
