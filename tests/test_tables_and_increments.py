"""Stored tables, high-water marks and incremental curation."""

import glob
from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from conftest import rows
from lakeops import contracts
from lakeops.operators import checks, incremental, views
from lakeops.plans import curate
from lakeops.sources import tables

ROUTES = "logistics_core.raw_route_updates"
FACT = "logistics_core.fact_vehicle_routes"


def _routes(spark, *items):
    """(id, time) pairs as raw route updates."""
    data = [(i, ts, "route_update", f"R-{i}", "ASSIGNED", ts, ts.date()) for i, ts in items]
    return spark.createDataFrame(data, contracts.TABLES[ROUTES].schema)


def _ids(df):
    return sorted(r.event_id for r in df.select("event_id").collect())


NOON = datetime(2024, 3, 1, 12)
HOUR = timedelta(hours=1)


def test_schema_of_columns():
    schema = contracts.schema_of(contracts.columns("a STRING, b LONG"))
    assert schema.simpleString() == "struct<a:string,b:bigint,event_date:date>"
    assert contracts.schema_of(contracts.columns("event_date DATE, a INT")).fieldNames() == ["event_date", "a"]
    with pytest.raises(ValueError):
        contracts.schema_of(contracts.columns("a FLOAT16"))


def test_queues():
    assert contracts.FEEDS["orders"].queues == ("orders_north", "orders_south", "orders_east", "orders_west")
    assert sum(len(f.queues) for f in contracts.FEEDS.values()) == 30


def test_ensure_table_creates_once(spark, warehouse):
    assert not tables.table_exists(spark, warehouse, FACT)
    assert tables.ensure_table(spark, warehouse, FACT)
    assert not tables.ensure_table(spark, warehouse, FACT)
    assert tables.scan(spark, warehouse, FACT).schema == contracts.TABLES[FACT].schema
    assert incremental.high_water_mark(spark, warehouse, FACT) is None
    assert tables.bootstrap_ml_tables(spark, warehouse) == ["ml_insights.raw_stockout_risk", "ml_insights.raw_demand_forecast"]
    assert tables.bootstrap_ml_tables(spark, warehouse) == []


def test_append_keeps_earlier_loads_and_replaces_its_own(spark, warehouse):
    tables.append(_routes(spark, ("a", NOON)), warehouse, ROUTES, "one")
    tables.append(_routes(spark, ("b", NOON)), warehouse, ROUTES, "two")
    tables.append(_routes(spark, ("b", NOON)), warehouse, ROUTES, "two")
    assert _ids(tables.scan(spark, warehouse, ROUTES)) == ["a", "b"]
    tables.append(_routes(spark, ("c", NOON)).limit(0), warehouse, ROUTES)
    assert _ids(tables.scan(spark, warehouse, ROUTES)) == ["a", "b"]


def test_a_date_with_most_rows_is_written_by_several_tasks(spark, warehouse):
    """AQE splits the hot date; a plain repartition by date would leave it in one file."""
    hot = spark.range(400_000).select(
        F.col("id").cast("string").alias("event_id"),
        F.lit(NOON).cast("timestamp_ntz").alias("event_ts"),
        F.lit("route_update").alias("event_type"),
        F.sha2(F.col("id").cast("string"), 256).alias("route_id"),
        F.lit("s").alias("status"),
        F.lit(NOON).cast("timestamp_ntz").alias("updated_ts"),
        F.expr("CASE WHEN id % 3 = 0 THEN date_add(date'2024-01-01', CAST(id % 5 AS INT)) ELSE date'2024-03-01' END").alias(
            "event_date"
        ),
    )
    before = spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", str(4 * 1024 * 1024))
    try:
        tables.append(hot, warehouse, ROUTES, "x")
    finally:
        spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", before)
    files = glob.glob(f"{tables.table_path(warehouse, ROUTES)}/event_date=2024-03-01/load_id=x/*.parquet")
    assert len(files) > 2
    assert tables.scan(spark, warehouse, ROUTES).count() == 400_000


def test_missing_optional_column_reads_as_null(spark, warehouse):
    """Order errors reach their fact although the raw table has no ``details``."""
    raw = [("e", NOON, "order_error", "x", "o", "UNKNOWN", NOON, NOON.date())]
    tables.append(
        spark.createDataFrame(raw, contracts.TABLES["order_errors.raw_order_errors"].schema), warehouse, "order_errors.raw_order_errors"
    )
    curate.run(spark, warehouse, "fact_order_errors")
    assert rows(tables.scan(spark, warehouse, "order_errors.fact_order_errors"), "event_id", "details") == [("e", None)]


def test_strict_mode_skips_ties_and_late_rows(spark, warehouse):
    tables.append(_routes(spark, ("a", NOON), ("b", NOON + HOUR)), warehouse, ROUTES)
    curate.run(spark, warehouse, "fact_vehicle_routes", mode="strict", lookback_hours=0)
    tables.append(_routes(spark, ("tie", NOON + HOUR), ("late", NOON), ("new", NOON + 2 * HOUR)), warehouse, ROUTES)
    curate.run(spark, warehouse, "fact_vehicle_routes", mode="strict", lookback_hours=0)
    assert _ids(tables.scan(spark, warehouse, FACT)) == ["a", "b", "new"]
    curate.run(spark, warehouse, "fact_vehicle_routes", mode="strict", lookback_hours=0)
    assert _ids(tables.scan(spark, warehouse, FACT)) == ["a", "b", "new"]


def test_lookback_repeats_rows_unless_idempotent(spark, warehouse, tmp_path):
    other = str(tmp_path / "other")
    for place, mode in ((warehouse, "strict"), (other, "idempotent")):
        tables.append(_routes(spark, ("a", NOON), ("b", NOON + HOUR), ("b", NOON + HOUR)), place, ROUTES)
        curate.run(spark, place, "fact_vehicle_routes", mode=mode, lookback_hours=2)
        tables.append(_routes(spark, ("late", NOON + HOUR / 2), ("too late", NOON - 24 * HOUR)), place, ROUTES)
        curate.run(spark, place, "fact_vehicle_routes", mode=mode, lookback_hours=2)
    assert _ids(tables.scan(spark, warehouse, FACT)) == ["a", "a", "b", "b", "b", "b", "late"]
    assert _ids(tables.scan(spark, other, FACT)) == ["a", "b", "late"]


def test_idempotent_scope(spark, warehouse, tmp_path):
    """An id reused on a later date is new within the window and known in the whole table."""
    other = str(tmp_path / "other")
    for place, scope in ((warehouse, "window"), (other, "table")):
        tables.append(_routes(spark, ("a", NOON - 72 * HOUR), ("b", NOON)), place, ROUTES)
        curate.run(spark, place, "fact_vehicle_routes", mode="idempotent", lookback_hours=1)
        tables.append(_routes(spark, ("a", NOON + HOUR)), place, ROUTES)
        curate.run(spark, place, "fact_vehicle_routes", mode="idempotent", lookback_hours=1, stored_scope=scope)
    assert _ids(tables.scan(spark, warehouse, FACT)) == ["a", "a", "b"]
    assert _ids(tables.scan(spark, other, FACT)) == ["a", "b"]


def test_dimension_increment(spark, warehouse):
    """A second run works for every dimension; the mark is a date."""
    tables.append(_routes(spark, ("a", NOON)), warehouse, ROUTES)
    curate.run(spark, warehouse, "dim_route", mode="strict", lookback_hours=0)
    tables.append(_routes(spark, ("same day", NOON + HOUR), ("next day", NOON + 24 * HOUR)), warehouse, ROUTES)
    curate.run(spark, warehouse, "dim_route", mode="strict", lookback_hours=0)
    stored = tables.scan(spark, warehouse, "dimensions.dim_route")
    assert rows(stored, "route_id", "event_date") == [("R-a", date(2024, 3, 1)), ("R-next day", date(2024, 3, 2))]


def test_dimension_without_key_is_idempotent(spark, warehouse):
    """Equal rows stay as often as they occur, late ones of the mark's own day come in, unchanged input adds nothing."""
    def orders(*items):
        values = [(f"e{k}{p}", NOON, "t", f"o{k}", p, "w", NOON, 1, NOON.date()) for k, p in enumerate(items)]
        return spark.createDataFrame(values, contracts.TABLES["orders.raw_orders"].schema)

    for delivery in (orders("a", "a", "b"), orders("a", "c"), orders()):
        tables.append(delivery, warehouse, "orders.raw_orders")
        curate.run(spark, warehouse, "dim_product", lookback_hours=0)
    stored = tables.scan(spark, warehouse, "dimensions.dim_product")
    assert [r[0] for r in rows(stored, "product_id")] == ["a", "a", "a", "b", "c"]


def test_unknown_mode(spark, warehouse):
    with pytest.raises(ValueError):
        curate.run(spark, warehouse, "fact_vehicle_routes", mode="other")


@pytest.mark.parametrize("text, hours", [(None, 0), ("6", 6), ("x", 0), ("-3", 0), ("", 0)])
def test_lookback_setting(monkeypatch, text, hours):
    if text is None:
        monkeypatch.delenv(incremental.LOOKBACK_ENV, raising=False)
    else:
        monkeypatch.setenv(incremental.LOOKBACK_ENV, text)
    assert incremental.lookback_from_env() == hours


def test_incremental_scan_prunes_partitions(spark, warehouse):
    tables.append(_routes(spark, ("a", NOON), ("b", NOON + 24 * HOUR)), warehouse, ROUTES)
    mark = incremental.Mark("2024-03-02 00:00:00", "timestamp_ntz")
    newer = incremental.newer_than(tables.scan(spark, warehouse, ROUTES), "updated_ts", mark, 3)
    assert _ids(newer) == ["b"]
    plan = newer._jdf.queryExecution().executedPlan().toString()
    assert "event_date" in plan.split("PartitionFilters: [")[1].split("]")[0]


def test_mark_reads_only_the_newest_partition(spark, warehouse):
    tables.append(_routes(spark, ("a", NOON), ("b", NOON + 24 * HOUR), ("c", NOON + 25 * HOUR)), warehouse, ROUTES)
    assert incremental.high_water_mark(spark, warehouse, ROUTES) == incremental.Mark("2024-03-02 13:00:00", "timestamp_ntz")


def test_curated_projection_is_not_shuffled(spark, warehouse):
    tables.append(_routes(spark, ("a", NOON)), warehouse, ROUTES)
    job = curate.JOBS["fact_vehicle_routes"]
    plan = job.build(tables.scan(spark, warehouse, ROUTES))._jdf.queryExecution().executedPlan().toString()
    assert job.narrow and "Exchange" not in plan


# Statements as dashboards send them.
DASHBOARD = {
    "SELECT warehouse_id, COUNT(*) AS total_orders FROM orders.fact_orders GROUP BY warehouse_id ORDER BY total_orders DESC": [
        ("WH-N1", 2),
        ("WH-S1", 1),
    ],
    "SELECT event_date, COUNT(*) AS total_orders FROM orders.fact_orders GROUP BY event_date ORDER BY event_date": [
        (date(2024, 3, 1), 3)
    ],
    "SELECT o.warehouse_id, COUNT(*) AS total_returns FROM returns.fact_returns r JOIN orders.fact_orders o "
    "ON r.order_id = o.order_id GROUP BY o.warehouse_id ORDER BY total_returns DESC": [("WH-N1", 2)],
}


def test_views_run_dashboard_sql(spark, warehouse):
    for name in contracts.FACTS + contracts.DIMS:  # the catalog is shared with other tests
        if spark.catalog.tableExists(name):
            spark.sql(f"DROP VIEW {name}")
    orders = [(f"e{i}", NOON, "order_created", f"o{i}", "P1", w, NOON, 1, NOON.date()) for i, w in enumerate(["WH-N1", "WH-N1", "WH-S1"])]
    returns = [(f"r{i}", NOON, "return_created", f"r{i}", o, NOON, "OTHER", NOON.date()) for i, o in enumerate(["o0", "o1", "o9"])]
    tables.append(spark.createDataFrame(orders, contracts.TABLES["orders.raw_orders"].schema), warehouse, "orders.raw_orders")
    tables.append(spark.createDataFrame(returns, contracts.TABLES["returns.raw_returns"].schema), warehouse, "returns.raw_returns")
    for name in ("fact_orders", "fact_returns", "dim_product", "dim_warehouse", "dim_error_code"):
        curate.run(spark, warehouse, name)
    tables.ensure_table(spark, warehouse, "dimensions.dim_route")

    results = {r.name: r for r in views.register_views(spark, warehouse)}
    assert results["orders.fact_orders"].created and results["dimensions.dim_route"].created
    missing = results["dimensions.dim_vehicle"]
    assert not missing.created and "missing table" in missing.reason
    for sql, expected in DASHBOARD.items():
        assert [tuple(r) for r in spark.sql(sql).collect()] == expected
    assert spark.table("orders.fact_orders").schema.simpleString() == contracts.TABLES["orders.fact_orders"].schema.simpleString()

    views.register_derived_view(
        spark,
        warehouse,
        "analytics.returns_by_warehouse",
        "SELECT o.warehouse_id AS warehouse_id, COUNT(*) AS total_returns, MIN(r.event_date) AS event_date "
        "FROM returns.fact_returns r JOIN orders.fact_orders o ON r.order_id = o.order_id GROUP BY o.warehouse_id",
    )
    assert rows(spark.table("analytics.returns_by_warehouse")) == [("WH-N1", 2, date(2024, 3, 1))]

    by_table = {r.table_name: r for r in checks.check_tables(spark, warehouse).collect()}
    assert len(by_table) == 10
    assert (by_table["orders.fact_orders"].status, by_table["orders.fact_orders"].row_count) == ("ok", 3)
    assert (by_table["dimensions.dim_vehicle"].status, by_table["dimensions.dim_vehicle"].message) == ("skipped", "table not found")
    by_view = {r.table_name: r.status for r in checks.check_views(spark, ("orders.fact_orders", "dimensions.dim_route", "dimensions.dim_vehicle")).collect()}
    assert by_view == {"orders.fact_orders": "ok", "dimensions.dim_route": "bad", "dimensions.dim_vehicle": "skipped"}
    assert checks.has_rows(spark.table("orders.fact_orders")) and not checks.has_rows(spark.table("dimensions.dim_route"))

    # dropping the views and their database leaves the tables alone
    spark.sql("DROP DATABASE returns CASCADE")
    assert tables.scan(spark, warehouse, "returns.fact_returns").count() == 3

    # rows appended later show up in the registered view
    late = [("e9", NOON + HOUR, "order_created", "o9", "P1", "WH-W1", NOON + HOUR, 1, NOON.date())]
    tables.append(spark.createDataFrame(late, contracts.TABLES["orders.raw_orders"].schema), warehouse, "orders.raw_orders")
    curate.run(spark, warehouse, "fact_orders", lookback_hours=0)
    spark.catalog.refreshTable("orders.fact_orders")
    assert spark.table("orders.fact_orders").count() == 4
