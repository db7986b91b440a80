"""Every registered query against its SQL."""

import pytest

import __spark_entry__ as entry_points
from tests.oracle import connect, difference
from tradewind.plans.registry import REGISTRY

# The text operators have tests of their own.
QUERIES = {name: run for name, run in entry_points.queries().items() if name in REGISTRY}
SQL = entry_points.oracle_sql()


@pytest.fixture(scope="module")
def connection(sf_dir):
    return connect(sf_dir)


def test_all_queries_have_sql():
    assert set(QUERIES) == set(REGISTRY) <= set(SQL)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_sql(spark, sf_dir, connection, name):
    df = QUERIES[name](spark, sf_dir)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "NestedLoopJoin" not in plan
    assert difference(df, connection, SQL[name]) is None


def test_entry(spark):
    assert entry_points.entry(spark).columns == ["month", "total_revenue"]
