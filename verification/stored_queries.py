"""Marts and dimensions kept up to date load by load, joins to large dimensions, and tables made from declarations."""

from __future__ import annotations

from dataclasses import replace
from functools import reduce

from lakeops.contracts import FEEDS, TABLES, Table, columns
from lakeops.operators import dedupe, joins, rules, views
from lakeops.plans import analytics, charts, current_state, forecast, stored_marts
from lakeops.sources import merging, tables
from lakeops.streaming import drain, late, requeue
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from verification import warehouse_queries  # noqa: F401 - its SQL is used below
from verification.ingest_queries import _DEFECTS, _defect_bodies
from verification.prediction_queries import RUN_TS
from verification.registry import ORACLE, Tables, query, register

# A dimension above the broadcast bound: every fact row once, hot keys spread.
for _fact, _dim, _key in (("fact_orders", "dim_product", "product_id"), ("fact_dispatch_logs", "dim_vehicle", "vehicle_id")):
    register(
        f"{_fact}_with_large_{_dim}",
        None,
        lambda t, f=_fact, d=_dim, k=_key: joins.with_dimension(
            t.curated(f), t.stored_current(d, k, "first_seen", "last_seen"), k, spread_by="event_id", limit_bytes=0
        ),
    )
    ORACLE[f"{_fact}_with_large_{_dim}"] = ORACLE[f"{_fact}_with_{_dim}"]


@query(
    "new_events_once",
    "SELECT * EXCLUDE (pick) FROM (SELECT *, row_number() OVER (PARTITION BY event_id ORDER BY event_ts, event_type, movement_id, "
    "product_id, delta_qty, source_type, event_date) AS pick FROM raw_inventory_movements r WHERE NOT EXISTS "
    "(SELECT 1 FROM raw_inventory_movements s WHERE s.source_type = 'RESTOCK' AND s.event_id = r.event_id)) WHERE pick = 1",
)
def new_events_once(t: Tables) -> DataFrame:
    """All movements, each event once, without the events that are stored already: the restocks."""
    rows = t.raw("raw_inventory_movements")
    return dedupe.new_once(rows, rows.where("source_type = 'RESTOCK'"), "event_id")


# The returns mart, stored. The tables are kept by month, with the day as a column.
_RETURNS = Table("returns.returns_by_month", columns("order_id STRING, return_date DATE, event_date DATE"))
_ORDERS = Table("orders.orders_by_month", columns("order_id STRING, warehouse_id STRING, event_date DATE"))
_MART = stored_marts.returns_mart("returns_by_warehouse", _RETURNS, _ORDERS, day="return_date")


@query(
    "stored_returns_mart",
    "SELECT o.warehouse_id, COUNT(*) AS total_returns, MIN(r.event_date) AS event_date FROM fact_returns r "
    "JOIN fact_orders o ON r.order_id = o.order_id GROUP BY o.warehouse_id",
)
def stored_returns_mart(t: Tables) -> DataFrame:
    """Two loads of each table, the second returns wrong at first; they are replaced, and the mart takes their part back."""
    warehouse = f"{t.scratch}/warehouse"
    month = F.trunc("event_date", "month")
    returns = t.curated("fact_returns").select("order_id", F.col("event_date").alias("return_date"), month.alias("event_date"))
    orders = t.curated("fact_orders").select("order_id", "warehouse_id", month.alias("event_date"))
    early = F.month("event_date") % 2 == 0
    wrong = returns.where(~early).withColumn("order_id", F.concat(F.col("order_id"), F.lit("0")))
    for returned, ordered, load in ((returns.where(early), orders.where(early), "early"), (wrong, orders.where(~early), "late"), (returns.where(~early), None, "late")):
        tables.append(returned, warehouse, _RETURNS, load)
        if ordered is not None:
            tables.append(ordered, warehouse, _ORDERS, load)
        stored_marts.refresh(t.spark, warehouse, _MART)
    return stored_marts.read(t.spark, warehouse, _MART)


_UPDATES = stored_marts.count_mart("updates_by_route", "logistics_core.fact_vehicle_routes", "route_id string", "updates")


@query("stored_updates_mart", "SELECT route_id, COUNT(*) AS updates FROM fact_vehicle_routes GROUP BY route_id")
def stored_updates_mart(t: Tables) -> DataFrame:
    """A load that is halved and one that is replaced by all its rows."""
    warehouse, facts = f"{t.scratch}/warehouse", t.curated("fact_vehicle_routes")
    even = F.xxhash64("event_id") % 2 == 0
    for rows, load in ((facts.where(even), "a"), (facts, "b"), (facts.where(~even), "b")):
        tables.append(rows, warehouse, "logistics_core.fact_vehicle_routes", load)
        stored_marts.refresh(t.spark, warehouse, _UPDATES)
    return stored_marts.read(t.spark, warehouse, _UPDATES)


@query(
    "current_route_by_loads",
    "SELECT route_id, CAST(NULL AS VARCHAR) AS region_covered, CAST(NULL AS INTEGER) AS avg_duration, min(event_date) AS first_seen, "
    "max(event_date) AS last_seen FROM dim_route GROUP BY route_id",
)
def current_route_by_loads(t: Tables) -> DataFrame:
    """Three loads, merged into the state one after the other."""
    warehouse, dim = f"{t.scratch}/warehouse", t.curated("dim_route")
    for part in range(3):
        tables.append(dim.where(F.pmod(F.dayofmonth("event_date") + F.length("route_id"), F.lit(3)) == part), warehouse, "dimensions.dim_route", f"load-{part}")
        current_state.update(t.spark, warehouse, "dimensions.dim_route", "route_id")
    return current_state.read(t.spark, warehouse, "dimensions.dim_route", "route_id")


# Tables made from declarations.
@query("declared_table", "SELECT route_id, status, updated_ts, event_date FROM raw_route_updates")
def declared_table(t: Tables) -> DataFrame:
    """A namespace and a table from a list of columns; the date column is added to it."""
    warehouse = f"{t.scratch}/warehouse"
    table = Table("logistics_core.route_states", columns("route_id STRING, status STRING, updated_ts TIMESTAMP"), mark="updated_ts")
    tables.ensure_namespace(t.spark, warehouse, table.module)
    tables.ensure_table(t.spark, warehouse, table)
    tables.append(t.raw("raw_route_updates"), warehouse, table)
    return tables.scan(t.spark, warehouse, table)


@query("bootstrapped_forecasts")
def bootstrapped_forecasts(t: Tables) -> DataFrame:
    """The prediction tables are made empty, then a forecast is stored in one of them."""
    warehouse = f"{t.scratch}/warehouse"
    tables.bootstrap_ml_tables(t.spark, warehouse)
    tables.append(forecast.demand_forecast(t.curated("fact_orders"), RUN_TS), warehouse, "ml_insights.raw_demand_forecast")
    return tables.scan(t.spark, warehouse, "ml_insights.raw_demand_forecast")


_WITHOUT_DETAILS = Table("order_errors.fact_order_errors", tuple(c for c in TABLES["order_errors.fact_order_errors"].columns if c.name != "details"))


@query(
    "views_of_differing_files",
    "SELECT error_code, COUNT(*) AS errors, COUNT(*) FILTER (WHERE day(event_date) % 2 = 0) AS with_details, MAX(event_date) AS last_day "
    "FROM fact_order_errors GROUP BY error_code",
)
def views_of_differing_files(t: Tables) -> DataFrame:
    """Files with and without a column under one view; the newest have it not."""
    warehouse, errors = f"{t.scratch}/warehouse", t.curated("fact_order_errors")
    even = F.day("event_date") % 2 == 0
    tables.append(errors.where(even).withColumn("details", F.lit("seen")), warehouse, "order_errors.fact_order_errors", "with")
    tables.append(errors.where(~even), warehouse, _WITHOUT_DETAILS, "without")
    views.register_view(t.spark, warehouse, "order_errors.fact_order_errors")
    return t.spark.sql(
        "SELECT error_code, COUNT(*) AS errors, COUNT(details) AS with_details, MAX(event_date) AS last_day "
        "FROM order_errors.fact_order_errors GROUP BY error_code"
    )


# Quarantined bodies under a contract that no longer asks for the order.
_RELAXED = replace(FEEDS["errors"], columns=tuple(c for c in FEEDS["errors"].columns if c.name != "order_id"))


@query(
    "requeued_defects",
    f"WITH bodies AS ({_DEFECTS}) SELECT CASE WHEN form IN (0, 6, 8, 9, 13) THEN 'first' WHEN form IN (3, 5) THEN 'requeued' ELSE 'quarantine' END AS place, "
    "CASE WHEN form IN (1, 2, 11) THEN 'not a JSON object' WHEN form = 4 THEN 'missing or invalid: error_code' "
    "WHEN form = 14 THEN 'missing or invalid: error_code,detected_ts' "
    "WHEN form NOT IN (0, 3, 5, 6, 8, 9, 13) THEN 'missing or invalid: detected_ts' END AS reason, COUNT(*) AS bodies FROM bodies GROUP BY 1, 2",
)
def requeued_defects(t: Tables) -> DataFrame:
    """Every body in exactly one place after two runs."""
    warehouse, feed = f"{t.scratch}/warehouse", FEEDS["errors"]
    drain.write_events(_defect_bodies(t), feed, warehouse, "errors_north-000000000000", ingest_ts="2024-03-01 00:00:00")
    for run in ("relaxed", "again"):
        requeue.requeue(t.spark, warehouse, _RELAXED, run)
    place = F.when(F.col("load_id").startswith("requeued-relaxed-"), "requeued").when(~F.col("load_id").startswith("requeued-"), "first").otherwise("twice")
    stored = tables.scan(t.spark, warehouse, feed.table, keep_load_id=True).select(place.alias("place"), F.lit(None).cast("string").alias("reason"))
    left = drain.read_quarantine(t.spark, warehouse, feed).select(F.lit("quarantine").alias("place"), "reason")
    return stored.unionByName(left).groupBy("place", "reason").agg(F.count("*").alias("bodies"))


# A stream of several batches in disorder.
_TOTALS = {"movements": "1L", "total_delta_qty": "delta_qty"}


@query(
    "stream_daily_inventory_corrected",
    "SELECT event_date, COUNT(*) AS movements, CAST(SUM(delta_qty) AS BIGINT) AS total_delta_qty FROM raw_inventory_movements GROUP BY event_date",
)
def stream_daily_inventory_corrected(t: Tables) -> DataFrame:
    """Most rows are later than the watermark; totals and corrections together are those of the batch query."""
    movements = t.raw("raw_inventory_movements").select("event_ts", "delta_qty")
    movements.repartition(4, F.xxhash64("event_ts", "delta_qty")).write.parquet(f"{t.scratch}/landing")
    stream = t.spark.readStream.schema(movements.schema).option("maxFilesPerTrigger", 1).parquet(f"{t.scratch}/landing")
    root = f"{t.scratch}/daily"
    late.start_daily_totals(stream, root, f"{t.scratch}/checkpoint", "event_ts", "3 days", _TOTALS).awaitTermination()
    return late.corrected(t.spark, root, movements.schema, "event_ts", _TOTALS)


@query("merged_small_loads", "SELECT * FROM fact_vehicle_routes")
def merged_small_loads(t: Tables) -> DataFrame:
    """Six loads, merged to one per date, twice."""
    warehouse, routes = f"{t.scratch}/warehouse", t.curated("fact_vehicle_routes")
    for k in range(6):
        tables.append(routes.where(F.pmod(F.xxhash64("event_id"), F.lit(6)) == k), warehouse, "logistics_core.fact_vehicle_routes", f"load-{k}")
    for _ in range(2):
        merging.merge_small_loads(t.spark, warehouse, "logistics_core.fact_vehicle_routes")
    return tables.scan(t.spark, warehouse, "logistics_core.fact_vehicle_routes")


# Rules, sketches and analytics that know no future.
_RULES = [
    rules.Rule("fact_orders", "required", "order_id"),
    rules.Rule("fact_orders", "required", "product_id"),
    rules.Rule("fact_orders", "unique", "event_id"),
    rules.Rule("fact_orders", "reference", "product_id", "dim_product.product_id"),
    rules.Rule("fact_inventory_movements", "unique", "event_id"),
    rules.Rule("fact_inventory_movements", "reference", "product_id", "dim_product.product_id"),
    rules.Rule("fact_returns", "required", "reason_code"),
    rules.Rule("fact_returns", "reference", "order_id", "fact_orders.order_id"),
    rules.Rule("fact_order_errors", "reference", "order_id", "fact_orders.order_id"),
    rules.Rule("fact_order_errors", "required", "details"),
]


def _rule_sql(rule: rules.Rule) -> str:
    table, column = rule.table, rule.column
    if rule.kind == "required":
        counts = f"COUNT(*) AS checked, COUNT(*) FILTER (WHERE {column} IS NULL OR CAST({column} AS VARCHAR) = '') AS failed FROM {table}"
    elif rule.kind == "unique":
        counts = f"COUNT({column}) AS checked, COUNT({column}) - COUNT(DISTINCT {column}) AS failed FROM {table}"
    else:
        other, key = rule.other.split(".")
        counts = f"COUNT({column}) AS checked, COUNT(*) FILTER (WHERE {column} IS NOT NULL AND {column} NOT IN (SELECT {key} FROM {other})) AS failed FROM {table}"
    return f"SELECT '{table}' AS table_name, '{rule.name}' AS rule, {counts}"


@query("table_rules", f"SELECT *, CASE WHEN failed = 0 THEN 'ok' ELSE 'bad' END AS status FROM ({' UNION ALL '.join(map(_rule_sql, _RULES))}) r")
def table_rules(t: Tables) -> DataFrame:
    names = {name for r in _RULES for name in (r.table, (r.other or r.table).split(".")[0])}
    return rules.report({name: t.curated(name) for name in names}, _RULES)


@query(
    "distinct_values_by_sketch",
    "SELECT column_name, exact_values, TRUE AS within_error FROM (SELECT 'product_id' AS column_name, COUNT(DISTINCT product_id) AS exact_values FROM fact_orders "
    "UNION ALL SELECT 'warehouse_id', COUNT(DISTINCT warehouse_id) FROM fact_orders UNION ALL SELECT 'order_id', COUNT(DISTINCT order_id) FROM fact_orders) d",
)
def distinct_values_by_sketch(t: Tables) -> DataFrame:
    """Sketches of each date, merged over all dates, against exact counts."""
    orders, columns = t.curated("fact_orders"), ["product_id", "warehouse_id", "order_id"]
    estimates = rules.distinct_estimates(rules.distinct_sketches(orders, columns))
    exact = reduce(DataFrame.unionByName, [orders.agg(F.count_distinct(c).alias("exact_values")).select(F.lit(c).alias("column_name"), "exact_values") for c in columns])
    off = F.abs(F.col("distinct_values") - F.col("exact_values")) <= rules.SKETCH_ERROR * F.col("exact_values") + 1
    return exact.join(estimates, "column_name").select("column_name", "exact_values", off.alias("within_error"))


@query(
    "features_as_known",
    "WITH risks AS (SELECT product_id, event_date, risk_score, confidence FROM (SELECT *, row_number() OVER (PARTITION BY product_id, event_date "
    "ORDER BY event_ts DESC, event_id DESC) AS pick FROM raw_stockout_risk) WHERE pick = 1), "
    "demand AS (SELECT product_id, event_date, forecast_qty FROM (SELECT *, row_number() OVER (PARTITION BY product_id, event_date "
    "ORDER BY event_ts DESC, event_id DESC) AS pick FROM raw_demand_forecast) WHERE pick = 1) "
    "SELECT o.event_id, o.order_id, o.product_id, o.warehouse_id, o.qty, o.event_date, r.risk_score, r.confidence, r.event_date AS risk_since, "
    "d.forecast_qty, d.event_date AS forecast_since FROM fact_orders o "
    "ASOF LEFT JOIN risks r ON o.product_id = r.product_id AND o.event_date > r.event_date "
    "ASOF LEFT JOIN demand d ON o.product_id = d.product_id AND o.event_date > d.event_date",
)
def features_as_known(t: Tables) -> DataFrame:
    return analytics.features_as_known(t.curated("fact_orders"), t.raw("raw_stockout_risk"), t.raw("raw_demand_forecast"))


@query(
    "trailing_anomalies",
    "WITH daily AS (SELECT product_id, event_date, CAST(SUM(qty) AS BIGINT) AS qty FROM fact_orders GROUP BY product_id, event_date), "
    "sums AS (SELECT *, COUNT(*) OVER w AS n, CAST(SUM(qty) OVER w AS HUGEINT) AS s, CAST(SUM(CAST(qty AS HUGEINT) * qty) OVER w AS HUGEINT) AS ss FROM daily "
    "WINDOW w AS (PARTITION BY product_id ORDER BY event_date RANGE BETWEEN INTERVAL 56 DAY PRECEDING AND INTERVAL 1 DAY PRECEDING)), "
    "measured AS (SELECT product_id, event_date, qty, CAST(s AS DOUBLE) / CAST(n AS DOUBLE) AS mean_qty, "
    "sqrt(CAST(n * ss - s * s AS DOUBLE) / CAST(n * (n - 1) AS DOUBLE)) AS sd_qty FROM sums WHERE n >= 5) "
    "SELECT * FROM measured WHERE sd_qty > 0 AND abs(CAST(qty AS DOUBLE) - mean_qty) > CAST(2 AS DOUBLE) * sd_qty",
)
def trailing_anomalies(t: Tables) -> DataFrame:
    """Each day against the eight weeks before it."""
    return analytics.trailing_anomalies(t.curated("fact_orders"), days=56, least=5, deviations=2.0)


@query(
    "demand_forecast_calendar",
    "WITH newest AS (SELECT MAX(event_date) AS day FROM fact_orders), "
    "averages AS (SELECT product_id, CAST(COALESCE(SUM(qty) FILTER (WHERE event_date > day - 28), 0) AS DOUBLE) / least(28, day - MIN(event_date) + 1) AS mean_qty "
    "FROM fact_orders, newest GROUP BY product_id, day) "
    f"SELECT sha256(concat('forecast_demand|{RUN_TS}|', product_id, '|global')) AS event_id, TIMESTAMP '{RUN_TS}' AS event_ts, "
    f"'forecast_demand' AS event_type, product_id, 'global' AS region, TIMESTAMP '{RUN_TS}' AS forecast_ts, "
    f"CAST(round_even(mean_qty, 0) AS BIGINT) AS forecast_qty, DATE '{RUN_TS[:10]}' AS event_date FROM averages",
)
def demand_forecast_calendar(t: Tables) -> DataFrame:
    """The mean of the last 28 calendar days; days without orders count."""
    return forecast.demand_forecast(t.curated("fact_orders"), RUN_TS, window_days=28, calendar=True)


@query(
    "chart_monthly_orders",
    'SELECT CAST(date_trunc(\'month\', event_date) AS DATE) AS event_date, COUNT(*) AS "count" FROM fact_orders GROUP BY 1 ORDER BY 1',
)
def chart_monthly_orders(t: Tables) -> DataFrame:
    return charts.chart_query(t.curated("fact_orders"), replace(charts.CHARTS["daily_orders"], grain="month"))


ORACLE["bootstrapped_forecasts"] = ORACLE["demand_forecast"]
