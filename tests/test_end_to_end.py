"""JSON events to raw tables to facts and dimensions to views, checks and dashboard SQL."""

import pytest
from pyspark.sql import functions as F

from conftest import rows
from lakeops.contracts import CHECKED_TABLES, FEEDS
from lakeops.operators import checks, views
from lakeops.plans import charts, curate, marts
from lakeops.sources import feeds, tables, testdata
from lakeops.streaming import drain
from verification.compare import duckdb_on
from verification.registry import complete

pytest.importorskip("duckdb")

# Short periods keep the number of date folders small; the registered queries run over whole tables.
PERIODS = {
    "raw_orders": ("1998-01-01", "1998-04-01"),
    "raw_returns": ("1998-01-01", "1998-04-01"),
    "raw_inventory_movements": ("1998-03-01", "1998-03-11"),
    "raw_dispatch_logs": ("1998-03-01", "1998-03-11"),
    "raw_order_errors": ("2024-01-05", "2024-01-15"),
}

def statement(chart):
    """The SQL that a dashboard sends for a chart over a stored table."""
    keys = ", ".join([*([chart.time_column] if chart.time_column else []), *chart.group_by])
    metrics = ", ".join(f"{sql} AS {name}" for name, sql in chart.metrics)
    return f"SELECT {keys}, {metrics} FROM {chart.dataset} GROUP BY {keys}"


DASHBOARD = {name: statement(c) for name, c in charts.CHARTS.items() if c.dataset in CHECKED_TABLES}
# Fixed value: the statement behind the mart of returns.
DASHBOARD["returns_by_warehouse"] = (
    "SELECT o.warehouse_id, COUNT(*) AS total_returns FROM returns.fact_returns r JOIN orders.fact_orders o ON r.order_id = o.order_id GROUP BY o.warehouse_id"
)


@pytest.fixture(scope="module")
def stored(spark, sf_dir, tmp_path_factory):
    warehouse = str(tmp_path_factory.mktemp("lake"))
    for feed in (FEEDS[n] for n in ("orders", "returns", "inventory", "errors", "dispatch_logs")):
        name = feed.table.split(".")[1]
        first, after = PERIODS[name]
        raw = testdata.raw_table(spark, sf_dir, name).where((F.col("event_date") >= first) & (F.col("event_date") < after))
        drain.write_events(feeds.to_bodies(raw, feed), feed, warehouse, f"{feed.name}-0")
    for table in CHECKED_TABLES:
        curate.run(spark, warehouse, table.split(".")[1], lookback_hours=0)
    results = views.register_views(spark, warehouse, CHECKED_TABLES)
    assert all(r.created for r in results)
    return warehouse


@pytest.fixture(scope="module")
def expected(sf_dir):
    connection = duckdb_on(sf_dir)

    def run(sql):
        """``sql`` on the raw tables of the period, with the view names of the warehouse."""
        text = complete(sql.replace("orders.fact", "fact").replace("returns.fact", "fact").replace("inventory.fact", "fact")
                        .replace("dispatch_logs.fact", "fact").replace("order_errors.fact", "fact").replace("dimensions.dim", "dim"))
        for name in PERIODS:
            derived = testdata.RAW[name]
            first, after = PERIODS[name]
            bounded = f"SELECT * FROM ({derived.sql()}) WHERE event_date >= DATE '{first}' AND event_date < DATE '{after}'"
            text = text.replace(f"({derived.sql()})", f"({bounded})")
        return sorted(connection.execute(text).fetchall(), key=repr)

    return run


@pytest.mark.parametrize("table", CHECKED_TABLES)
def test_view_is_complete_and_not_empty(spark, stored, expected, table):
    assert checks.has_rows(spark.table(table))
    names = ", ".join(f'"{c}"' for c in spark.table(table).columns)
    assert rows(spark.table(table)) == expected(f"SELECT {names} FROM {table}")


def test_reports(spark, stored):
    for report in (checks.check_tables(spark, stored), checks.check_views(spark)):
        assert [r.status for r in report.collect()] == ["ok"] * 10


@pytest.mark.parametrize("name", DASHBOARD)
def test_dashboard_sql(spark, stored, expected, name):
    want = expected(DASHBOARD[name])
    assert want and rows(spark.sql(DASHBOARD[name])) == want


def test_marts_on_stored_tables(spark, stored, expected):
    orders, returns = (tables.scan(spark, stored, n) for n in ("orders.fact_orders", "returns.fact_returns"))
    assert rows(marts.returns_by_warehouse(returns, orders)) == expected(DASHBOARD["returns_by_warehouse"])
    daily = marts.daily_orders(orders)
    assert rows(daily) == expected(DASHBOARD["daily_orders"])
    plan = daily._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<>" in plan  # dates and counts come from the folders and file footers


def test_charts_on_views(spark, stored):
    for chart in charts.CHARTS.values():
        if chart.dataset in CHECKED_TABLES:
            assert not charts.chart_query(spark.table(chart.dataset), chart).isEmpty()


def test_second_run_adds_nothing(spark, stored):
    before = {t: tables.scan(spark, stored, t).count() for t in CHECKED_TABLES}
    for table in CHECKED_TABLES:
        curate.run(spark, stored, table.split(".")[1], lookback_hours=0)
    assert {t: tables.scan(spark, stored, t).count() for t in CHECKED_TABLES} == before
