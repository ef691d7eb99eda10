"""Dimensions, joins, marts, predictions and analytics on small frames, against brute force."""

import random
from collections import Counter
import statistics
from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from conftest import rows
from lakeops.functions.calendar import calendar_parts
from lakeops.functions.ids import region_of
from lakeops.operators import dedupe, joins
from lakeops.plans import analytics, charts, dims, forecast, marts

DAY = date(2024, 1, 1)


def test_calendar_parts(spark):
    days = [date(2015, 1, 1) + timedelta(days=i) for i in range(5844)]
    got = spark.createDataFrame([(d,) for d in days], "d date").select("d", *calendar_parts(F.col("d"))).collect()
    for r in got:
        expected = (r.d.day, int(r.d.strftime("%W")), r.d.month, (r.d.month + 2) // 3, r.d.year)
        assert (r.day, r.week, r.month, r.quarter, r.year) == expected, r.d


def test_region_of(spark):
    ids = [("WH-N1",), ("V-S22",), ("WH-E1",), ("WH-W3",), ("VEH-001",), ("",), (None,)]
    got = [r[0] for r in spark.createDataFrame(ids, "id string").select(region_of(F.col("id"))).collect()]
    assert got == ["north", "south", "east", "west", None, None, None]


def test_dimension_keeps_a_row_per_event_and_drops_empty_keys(spark):
    raw = spark.createDataFrame([("p", DAY), ("p", DAY), ("", DAY), (None, DAY)], "product_id string, event_date date")
    dim = dims.dim_product(raw)
    assert rows(dim) == [("p", None, None, None, DAY)] * 2
    assert rows(dims.current(dim, "product_id")) == [("p", None, None, None, DAY, DAY)]


def test_current_takes_known_attributes(spark):
    dim = spark.createDataFrame(
        [("p", None, DAY), ("p", "tools", DAY + timedelta(days=3)), ("q", None, DAY)],
        "product_id string, category string, event_date date",
    )
    assert rows(dims.current(dim, "product_id")) == [
        ("p", "tools", DAY, DAY + timedelta(days=3)),
        ("q", None, DAY, DAY),
    ]


@pytest.fixture(scope="module")
def hot(spark):
    """Returns and orders in which one order id has a third of all rows on both sides."""
    rng = random.Random(7)
    returns = [("hot" if rng.random() < 0.34 else f"o{rng.randrange(50)}", DAY + timedelta(days=rng.randrange(9))) for _ in range(900)]
    orders = [("hot" if rng.random() < 0.34 else f"o{rng.randrange(50)}", f"WH-{rng.choice('NSEW')}1") for _ in range(600)]
    returns += [(None, DAY)] * 5
    orders += [(None, "WH-N1")] * 5 + [("o1", None)]
    return (
        returns,
        orders,
        spark.createDataFrame(returns, "order_id string, event_date date"),
        spark.createDataFrame(orders, "order_id string, warehouse_id string"),
    )


def test_returns_by_warehouse_with_a_hot_order(hot):
    returns, orders, returns_df, orders_df = hot
    count, first = Counter(), {}
    for order_id, day in returns:
        for other, warehouse in orders:
            if order_id is not None and order_id == other:
                count[warehouse] += 1
                first[warehouse] = min(first.get(warehouse, day), day)
    mart = marts.returns_by_warehouse_mart(returns_df, orders_df)
    assert rows(mart) == sorted(((w, n, first[w]) for w, n in count.items()), key=repr)
    assert {tuple(r) for r in marts.returns_by_warehouse(returns_df, orders_df).collect()} == set(count.items())


def test_join_to_a_large_dimension_is_salted_and_complete(spark):
    facts = spark.range(3000).select(
        F.col("id").cast("string").alias("event_id"),
        F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") % 7 == 0, None).otherwise(F.concat(F.lit("k"), F.col("id") % 40)).alias("k"),
    )
    dimension = spark.createDataFrame([("hot", 1)] + [(f"k{i}", i) for i in range(30)], "k string, v int")
    small = joins.with_dimension(facts, dimension, "k", spread_by="event_id")
    large = joins.with_dimension(facts, dimension, "k", spread_by="event_id", limit_bytes=1, salts=8)
    assert "_salt" in large._jdf.queryExecution().optimizedPlan().toString()
    assert small.count() == 3000
    assert rows(small, "event_id", "k", "v") == rows(large, "event_id", "k", "v")


def test_dedupe_with_a_hot_key(spark):
    rng = random.Random(3)
    data = [("hot" if rng.random() < 0.4 else f"e{rng.randrange(200)}", rng.randrange(100), rng.choice("ab")) for _ in range(2000)]
    df = spark.createDataFrame(data, "event_id string, n int, c string").repartition(5)
    expected = {}
    for key, *rest in data:
        expected[key] = min(expected.get(key, tuple(rest)), tuple(rest))
    assert rows(dedupe.one_row_per(df, "event_id")) == sorted(((k, *v) for k, v in expected.items()), key=repr)
    stored = df.where("c = 'a'")
    known = {k for k, _, c in data if c == "a"}
    assert {r.event_id for r in dedupe.not_stored(dedupe.one_row_per(df, "event_id"), stored, "event_id").collect()} == set(expected) - known


def test_chart_order_limit_and_errors(spark):
    df = spark.createDataFrame([("a", 1), ("b", 5), ("b", 1), ("c", 2)], "k string, v int")
    chart = charts.Chart("t", "x.y", (("total", "SUM(v)"),), ("k",), row_limit=2)
    assert [tuple(r) for r in charts.chart_query(df, chart).collect()] == [("b", 6), ("c", 2)]
    rising = charts.Chart("t", "x.y", (("total", "SUM(v)"), ("n", "COUNT(*)")), ("k",), descending=False, row_limit=1)
    assert [tuple(r) for r in charts.chart_query(df, rising).collect()] == [("a", 1, 1)]
    with pytest.raises(ValueError):
        charts.chart_query(df, charts.Chart("t", "x.y", (("n", "COUNT(*)"),)))
    assert len(charts.CHARTS) == 12


def _orders(spark, items):
    data = [(f"e{i}", p, "WH-N1", q, d) for i, (p, q, d) in enumerate(items)]
    return spark.createDataFrame(data, "event_id string, product_id string, warehouse_id string, qty bigint, event_date date")


def test_forecast_rounds_half_to_even_over_the_last_days(spark):
    items = [("p", 1000, DAY)] + [("p", q, DAY + timedelta(days=i + 1)) for i, q in enumerate([2, 3])] + [("q", 5, DAY)]
    got = forecast.demand_forecast(_orders(spark, items), "2024-02-01 00:00:00", window_days=2)
    assert rows(got, "product_id", "region", "forecast_qty") == [("p", "global", 2), ("q", "global", 5)]
    again = forecast.demand_forecast(_orders(spark, items), "2024-02-01 00:00:00", window_days=2)
    assert rows(got) == rows(again)
    assert forecast.demand_forecast(_orders(spark, items).limit(0), "2024-02-01 00:00:00").count() == 0
    history = [41, 77, 60, 58, 92, 13, 70]  # mean 58.7
    week = _orders(spark, [("p", q, DAY + timedelta(days=i)) for i, q in enumerate(history)])
    assert forecast.demand_forecast(week, "2024-02-01 00:00:00").first().forecast_qty == 59


def test_stockout_risk(spark):
    orders = _orders(spark, [(p, 10, DAY + timedelta(days=i)) for p in ("low", "high", "none") for i in range(7)])
    stock = spark.createDataFrame([("low", 60), ("low", -10), ("high", 10_000), ("other", 5)], "product_id string, delta_qty bigint")
    got = {r.product_id: r for r in forecast.stockout_risk(stock, orders, "2024-02-01 00:00:00").collect()}
    assert set(got) == {"low", "high", "none"}
    assert got["low"].predicted_date == date(2024, 2, 6) and got["low"].risk_score == pytest.approx(1 - 5 / 30)
    assert got["high"].risk_score == 0.0 and got["high"].predicted_date > date(2024, 3, 2)
    assert (got["none"].risk_score, got["none"].predicted_date, got["none"].confidence) == (1.0, date(2024, 2, 1), 1.0)


def test_predictions_are_written_once_per_run(spark, warehouse):
    """Orders and stock to prediction tables to their facts and the risk mart; a repeated run changes nothing."""
    from lakeops.contracts import TABLES
    from lakeops.plans import curate
    from lakeops.sources import tables

    noon = datetime(2024, 1, 5, 12)
    orders = [(f"e{i}", noon, "order_created", f"o{i}", "p", "WH-N1", noon, 10, noon.date()) for i in range(3)]
    moves = [("m", noon, "inventory_movement", "p", noon, 60, "RESTOCK", noon.date())]
    for name, data in (("orders.fact_orders", orders), ("inventory.fact_inventory_movements", moves)):
        tables.append(spark.createDataFrame(data, TABLES[name].schema), warehouse, name)
    tables.bootstrap_ml_tables(spark, warehouse)
    for _ in range(2):
        forecast.write_demand_forecast(spark, warehouse, "2024-02-01 00:00:00")
        forecast.write_demand_forecast(spark, warehouse, "2024-02-01 00:00:00", by_region=True)
        forecast.write_stockout_risk(spark, warehouse, "2024-02-01 00:00:00")
    demand = tables.scan(spark, warehouse, "ml_insights.raw_demand_forecast")
    assert rows(demand, "product_id", "region", "forecast_qty") == [("p", "global", 30), ("p", "north", 30)]
    risk = tables.scan(spark, warehouse, "ml_insights.raw_stockout_risk")
    assert rows(marts.average_stockout_risk(risk)) == [("p", 1 - 2 / 30)]
    for name in ("fact_forecast_demand", "fact_stockout_risks"):
        curate.run(spark, warehouse, name, lookback_hours=0)
    assert tables.scan(spark, warehouse, "ml_insights.fact_forecast_demand").count() == 2
    stored = tables.scan(spark, warehouse, "ml_insights.fact_stockout_risks")
    assert rows(stored, "product_id", "predicted_date") == [("p", date(2024, 2, 3))]


def test_sla_violations(spark):
    sla = spark.createDataFrame(
        [("V-N1", 30, 45), ("V-N1", 30, 30), ("V-S1", 30, 20), ("X", 10, 11)],
        "vehicle_id string, sla_minutes bigint, actual_minutes bigint",
    )
    vehicles = spark.createDataFrame([("V-N1", "truck"), ("V-S1", None)], "vehicle_id string, type string")
    assert rows(analytics.sla_violations(sla, vehicles)) == [
        ("V-S1", "south", 1, 0, 0, 0.0),
        ("X", "unknown", 1, 1, 1, 1.0),
        ("truck", "north", 2, 1, 15, 0.5),
    ]


def test_order_anomalies(spark):
    items = [("p", 10 + i % 2, DAY + timedelta(days=i)) for i in range(30)] + [("p", 500, DAY + timedelta(days=40)), ("once", 9, DAY)]
    got = analytics.order_anomalies(_orders(spark, items)).collect()
    assert [(r.product_id, r.qty, r.event_date) for r in got] == [("p", 500, DAY + timedelta(days=40))]


def test_anomalies_of_large_totals_keep_their_digits(spark):
    """Totals of two billion a day neither overflow nor cancel."""
    values = [2_000_000_000 + k % 3 for k in range(30)] + [2_000_000_100]
    orders = _orders(spark, [("p", q, DAY + timedelta(days=i)) for i, q in enumerate(values)])
    got = analytics.order_anomalies(orders).collect()
    assert [r.qty for r in got] == [2_000_000_100]
    assert got[0].sd_qty == pytest.approx(statistics.stdev(values), rel=1e-12)


def test_current_takes_the_last_value_of_each_attribute(spark):
    seen = [("p", "old", "a", 5, date(2020, 1, 1)), ("p", "new", None, 3, date(2024, 1, 1)), ("q", None, None, None, date(2024, 1, 1))]
    dim = spark.createDataFrame(seen, "product_id string, name string, category string, unit_cost int, event_date date")
    assert rows(dims.current(dim, "product_id"), "product_id", "name", "category", "unit_cost") == [("p", "new", "a", 3), ("q", None, None, None)]
