"""Facts, dimensions, marts, charts, joins and checks."""

from __future__ import annotations

from dataclasses import replace
from functools import reduce

from lakeops.contracts import CHECKED_TABLES, FACTS, TABLES
from lakeops.operators import checks, incremental, joins, views
from lakeops.plans import charts, marts
from lakeops.plans.curate import JOBS
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from verification.registry import Tables, query, register

# Facts and reference-shaped dimensions.
for _name in JOBS:
    register(_name, f"SELECT * FROM {_name}", lambda t, n=_name: t.curated(n))

# One row per key.
for _name, _key in (
    ("dim_product", "product_id"),
    ("dim_warehouse", "warehouse_id"),
    ("dim_vehicle", "vehicle_id"),
    ("dim_error_code", "error_code"),
    ("dim_route", "route_id"),
    ("dim_date", "date_id"),
):
    _attributes = [f.name for f in TABLES[f"dimensions.{_name}"].schema.fields if f.name not in (_key, "event_date")]
    _maxima = ", ".join(f'max("{a}") AS "{a}"' for a in _attributes)
    register(
        _name.replace("dim_", "current_"),
        f"SELECT {_key}, {_maxima}, min(event_date) AS first_seen, max(event_date) AS last_seen FROM {_name} GROUP BY {_key}",
        lambda t, n=_name, k=_key: t.current(n, k),
    )


@query(
    "orders_by_warehouse",
    "SELECT warehouse_id, COUNT(*) AS total_orders FROM fact_orders GROUP BY warehouse_id ORDER BY total_orders DESC, warehouse_id",
)
def orders_by_warehouse(t: Tables) -> DataFrame:
    return marts.orders_by_warehouse(t.curated("fact_orders"))


@query(
    "orders_by_product",
    "SELECT product_id, COUNT(*) AS total_orders FROM fact_orders GROUP BY product_id ORDER BY total_orders DESC, product_id",
)
def orders_by_product(t: Tables) -> DataFrame:
    return marts.orders_by_product(t.curated("fact_orders"))


@query("daily_orders", "SELECT event_date, COUNT(*) AS total_orders FROM fact_orders GROUP BY event_date ORDER BY event_date")
def daily_orders(t: Tables) -> DataFrame:
    return marts.daily_orders(t.curated("fact_orders"))


@query(
    "returns_by_warehouse",
    "SELECT o.warehouse_id, COUNT(*) AS total_returns FROM fact_returns r JOIN fact_orders o ON r.order_id = o.order_id "
    "GROUP BY o.warehouse_id ORDER BY total_returns DESC, o.warehouse_id",
)
def returns_by_warehouse(t: Tables) -> DataFrame:
    return marts.returns_by_warehouse(t.curated("fact_returns"), t.curated("fact_orders"))


# Fixed value: the statement behind the mart of returns.
@query(
    "returns_by_warehouse_mart",
    "SELECT o.warehouse_id, COUNT(*) AS total_returns, MIN(r.event_date) AS event_date FROM fact_returns r "
    "JOIN fact_orders o ON r.order_id = o.order_id GROUP BY o.warehouse_id",
)
def returns_by_warehouse_mart(t: Tables) -> DataFrame:
    return marts.returns_by_warehouse_mart(t.curated("fact_returns"), t.curated("fact_orders"))


@query(
    "returns_by_reason",
    "SELECT reason_code, COUNT(*) AS total_returns FROM fact_returns GROUP BY reason_code ORDER BY total_returns DESC, reason_code",
)
def returns_by_reason(t: Tables) -> DataFrame:
    return marts.returns_by_reason(t.curated("fact_returns"))


@query("daily_returns", "SELECT event_date, COUNT(*) AS total_returns FROM fact_returns GROUP BY event_date ORDER BY event_date")
def daily_returns(t: Tables) -> DataFrame:
    return marts.daily_returns(t.curated("fact_returns"))


@query(
    "inventory_by_product",
    "SELECT product_id, CAST(SUM(delta_qty) AS BIGINT) AS total_delta_qty FROM fact_inventory_movements "
    "GROUP BY product_id ORDER BY total_delta_qty DESC, product_id",
)
def inventory_by_product(t: Tables) -> DataFrame:
    return marts.inventory_by_product(t.curated("fact_inventory_movements"))


@query(
    "daily_inventory",
    "SELECT event_date, CAST(SUM(delta_qty) AS BIGINT) AS total_delta_qty FROM fact_inventory_movements "
    "GROUP BY event_date ORDER BY event_date",
)
def daily_inventory(t: Tables) -> DataFrame:
    return marts.daily_inventory(t.curated("fact_inventory_movements"))


@query(
    "dispatch_by_status",
    "SELECT status, COUNT(*) AS event_count FROM fact_dispatch_logs GROUP BY status ORDER BY event_count DESC, status",
)
def dispatch_by_status(t: Tables) -> DataFrame:
    return marts.dispatch_by_status(t.curated("fact_dispatch_logs"))


@query(
    "dispatch_by_vehicle_and_status",
    "SELECT vehicle_id, status, COUNT(*) AS event_count FROM fact_dispatch_logs GROUP BY vehicle_id, status "
    "ORDER BY event_count DESC, vehicle_id, status",
)
def dispatch_by_vehicle_and_status(t: Tables) -> DataFrame:
    return marts.dispatch_by_vehicle_and_status(t.curated("fact_dispatch_logs"))


@query("daily_dispatch", 'SELECT event_date, COUNT(*) AS "count" FROM fact_dispatch_logs GROUP BY event_date ORDER BY event_date')
def daily_dispatch(t: Tables) -> DataFrame:
    return marts.daily_dispatch(t.curated("fact_dispatch_logs"))


@query(
    "average_stockout_risk",
    "SELECT product_id, AVG(risk_score) AS avg_risk_score FROM raw_stockout_risk GROUP BY product_id "
    "ORDER BY avg_risk_score DESC, product_id",
)
def average_stockout_risk(t: Tables) -> DataFrame:
    return marts.average_stockout_risk(t.raw("raw_stockout_risk"))


# Charts show every group and day; one asks for its ten largest groups.
_CHART_SQL = {
    "orders_by_warehouse": ("fact_orders", "warehouse_id", 'COUNT(*) AS "count"', '"count" DESC, warehouse_id'),
    "orders_by_product": ("fact_orders", "product_id", 'COUNT(*) AS "count"', '"count" DESC, product_id'),
    "daily_orders": ("fact_orders", "event_date", 'COUNT(*) AS "count"', "event_date"),
    "returns_by_reason": ("fact_returns", "reason_code", 'COUNT(*) AS "count"', '"count" DESC, reason_code'),
    "daily_returns": ("fact_returns", "event_date", 'COUNT(*) AS "count"', "event_date"),
    "inventory_by_product": (
        "fact_inventory_movements",
        "product_id",
        "CAST(SUM(delta_qty) AS BIGINT) AS sum_delta_qty",
        "sum_delta_qty DESC, product_id",
    ),
    "daily_inventory": (
        "fact_inventory_movements",
        "event_date",
        "CAST(SUM(delta_qty) AS BIGINT) AS sum_delta_qty",
        "event_date",
    ),
    "dispatch_by_status": ("fact_dispatch_logs", "status", 'COUNT(*) AS "count"', '"count" DESC, status'),
    "daily_dispatch": ("fact_dispatch_logs", "event_date", 'COUNT(*) AS "count"', "event_date"),
    "dispatch_heatmap": (
        "fact_dispatch_logs",
        "vehicle_id, status",
        'COUNT(*) AS "count"',
        '"count" DESC, vehicle_id, status',
    ),
    "stockout_risk": (
        "raw_stockout_risk",
        "product_id",
        "AVG(risk_score) AS avg_risk_score",
        "avg_risk_score DESC, product_id",
    ),
}


def _chart_data(t: Tables, chart: charts.Chart) -> DataFrame:
    name = chart.dataset.split(".")[1]
    if name == "returns_by_warehouse":
        return marts.returns_by_warehouse_mart(t.curated("fact_returns"), t.curated("fact_orders"))
    return t.raw(name) if name.startswith("raw_") else t.curated(name)


for _name, (_table, _keys, _metric, _order) in _CHART_SQL.items():
    register(
        f"chart_{_name}",
        f"SELECT {_keys}, {_metric} FROM {_table} GROUP BY {_keys} ORDER BY {_order}",
        lambda t, c=charts.CHARTS[_name]: charts.chart_query(_chart_data(t, c), c),
    )
register(
    "chart_ten_products",
    'SELECT product_id, COUNT(*) AS "count" FROM fact_orders GROUP BY product_id ORDER BY "count" DESC, product_id LIMIT 10',
    lambda t: charts.chart_query(t.curated("fact_orders"), replace(charts.CHARTS["orders_by_product"], row_limit=10)),
)
register(
    "chart_returns_by_warehouse",
    "SELECT o.warehouse_id, COUNT(*) AS total_returns FROM fact_returns r JOIN fact_orders o ON r.order_id = o.order_id "
    "GROUP BY o.warehouse_id ORDER BY total_returns DESC, o.warehouse_id",
    lambda t: charts.chart_query(
        _chart_data(t, charts.CHARTS["returns_by_warehouse"]), charts.CHARTS["returns_by_warehouse"]
    ),
)


@query(
    "returns_per_order",
    "SELECT o.order_id, o.warehouse_id, COUNT(*) AS total_returns, MIN(r.event_date) AS event_date FROM fact_returns r "
    "JOIN fact_orders o ON r.order_id = o.order_id GROUP BY o.order_id, o.warehouse_id",
)
def returns_per_order(t: Tables) -> DataFrame:
    return joins.returns_per_order(t.curated("fact_returns"), t.curated("fact_orders"))


@query(
    "sql_on_derived_view",
    "SELECT MIN(event_date) AS first_return, CAST(SUM(total_returns) AS BIGINT) AS total_returns, COUNT(*) AS warehouses FROM "
    "(SELECT o.warehouse_id, COUNT(*) AS total_returns, MIN(r.event_date) AS event_date FROM fact_returns r "
    "JOIN fact_orders o ON r.order_id = o.order_id GROUP BY o.warehouse_id) m",
)
def sql_on_derived_view(t: Tables) -> DataFrame:
    """The returns mart under a name, read back by SQL."""
    views.register_frame(returns_by_warehouse_mart(t), "returns_by_warehouse")
    return t.spark.sql(
        "SELECT MIN(event_date) AS first_return, SUM(total_returns) AS total_returns, COUNT(*) AS warehouses FROM returns_by_warehouse"
    )


# Fact to dimension joins of the star schema.
for _fact, _dim, _key in (
    ("fact_orders", "dim_product", "product_id"),
    ("fact_orders", "dim_warehouse", "warehouse_id"),
    ("fact_inventory_movements", "dim_product", "product_id"),
    ("fact_dispatch_logs", "dim_vehicle", "vehicle_id"),
):
    register(
        f"{_fact}_with_{_dim}",
        f"SELECT f.*, d.first_seen, d.last_seen FROM {_fact} f LEFT JOIN (SELECT {_key} AS k, min(event_date) AS first_seen, "
        f"max(event_date) AS last_seen FROM {_dim} GROUP BY {_key}) d ON f.{_key} = d.k",
        lambda t, f=_fact, d=_dim, k=_key: joins.with_dimension(
            t.curated(f), t.stored_current(d, k, "first_seen", "last_seen"), k, spread_by="event_id"
        ),
    )


_SHORT = {name: name.split(".")[1] for name in CHECKED_TABLES}


@query(
    "table_checks",
    " UNION ALL ".join(
        f"SELECT '{full}' AS table_name, TRUE AS table_exists, COUNT(*) AS row_count, "
        f"CASE WHEN COUNT(*) > 0 THEN 'ok' ELSE 'bad' END AS status, concat('count=', CAST(COUNT(*) AS VARCHAR)) AS message FROM {short}"
        for full, short in _SHORT.items()
    ),
)
def table_checks(t: Tables) -> DataFrame:
    return checks.report(t.spark, {full: t.curated(short) for full, short in _SHORT.items()})


@query("order_count", "SELECT COUNT(*) AS cnt FROM fact_orders")
def order_count(t: Tables) -> DataFrame:
    return checks.row_count(t.curated("fact_orders"))


@query(
    "high_water_marks",
    " UNION ALL ".join(
        f"SELECT '{name}' AS table_name, MAX({TABLES[name].mark}) AS mark FROM {name.split('.')[1]}" for name in FACTS
    ),
)
def high_water_marks(t: Tables) -> DataFrame:
    tops = [incremental.newest(t.curated(name.split(".")[1]), TABLES[name]).select(F.lit(name).alias("table_name"), "mark") for name in FACTS]
    return reduce(DataFrame.unionByName, tops)
