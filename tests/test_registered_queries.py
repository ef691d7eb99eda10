"""Every registered query gives the rows of its SQL on DuckDB, with the same names and types."""

import pytest

import __spark_entry__ as entry
from verification.compare import differences, duckdb_on
from verification.registry import QUERIES

duckdb = pytest.importorskip("duckdb")


@pytest.fixture(scope="module")
def connection(sf_dir):
    return duckdb_on(sf_dir)


def test_every_query_has_its_sql():
    assert set(QUERIES) <= set(entry.queries())
    assert set(QUERIES) <= set(entry.oracle_sql())


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_matches_its_sql(spark, sf_dir, connection, name):
    got = entry.queries()[name](spark, sf_dir).toArrow()
    expected = connection.execute(entry.oracle_sql()[name]).to_arrow_table()
    assert differences(got, expected) is None


def test_entry_runs(spark, sf_dir):
    assert entry.entry(spark).count() > 0


def test_no_cross_join_and_no_python_in_the_marts(spark, sf_dir):
    """Plans stay on the JVM and never compare all pairs."""
    for name in ("returns_by_warehouse", "orders_by_product", "stockout_risk", "order_anomalies", "ingest_orders"):
        plan = entry.queries()[name](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
        for operator in ("CartesianProduct", "NestedLoopJoin", "ArrowEvalPython", "BatchEvalPython", "MapInPandas"):
            assert operator not in plan, (name, operator)
