"""Forecasts, risks and declared analytics."""

from __future__ import annotations

from lakeops.plans import analytics, forecast
from pyspark.sql import DataFrame

from verification.registry import Tables, query

RUN_TS = "2025-01-01 06:00:00"

_REGION = (
    "CASE substr({id}, {at}, 1) WHEN 'N' THEN 'north' WHEN 'S' THEN 'south' WHEN 'E' THEN 'east' WHEN 'W' THEN 'west' END"
)


def _averages(region: str) -> str:
    return (
        f"history AS (SELECT product_id, {region} AS region, event_date, SUM(qty) AS qty FROM fact_orders GROUP BY ALL), "
        "ranked AS (SELECT *, row_number() OVER (PARTITION BY product_id, region ORDER BY event_date DESC) AS day_rank FROM history), "
        "averages AS (SELECT product_id, region, CAST(SUM(qty) AS DOUBLE) / COUNT(*) AS mean_qty, COUNT(*) AS days FROM ranked "
        "WHERE day_rank <= 7 GROUP BY product_id, region)"
    )


def _forecast_sql(region: str) -> str:
    return (
        f"WITH {_averages(region)} "
        f"SELECT sha256(concat('forecast_demand|{RUN_TS}|', product_id, '|', region)) AS event_id, TIMESTAMP '{RUN_TS}' AS event_ts, "
        f"'forecast_demand' AS event_type, product_id, region, TIMESTAMP '{RUN_TS}' AS forecast_ts, "
        f"CAST(round_even(mean_qty, 0) AS BIGINT) AS forecast_qty, DATE '{RUN_TS[:10]}' AS event_date FROM averages"
    )


@query("demand_forecast", _forecast_sql("'global'"))
def demand_forecast(t: Tables) -> DataFrame:
    return forecast.demand_forecast(t.curated("fact_orders"), RUN_TS)


@query("demand_forecast_by_region", _forecast_sql(_REGION.format(id="warehouse_id", at=4)))
def demand_forecast_by_region(t: Tables) -> DataFrame:
    return forecast.demand_forecast(t.curated("fact_orders"), RUN_TS, by_region=True)


@query(
    "stockout_risk",
    f"WITH {_averages(chr(39) + 'global' + chr(39))}, "
    "stock AS (SELECT product_id, SUM(delta_qty) AS net_qty FROM fact_inventory_movements GROUP BY product_id), "
    "covered AS (SELECT a.product_id, a.days, "
    "CAST(greatest(coalesce(s.net_qty, 0), 0) AS DOUBLE) / a.mean_qty AS cover "
    "FROM averages a LEFT JOIN stock s ON a.product_id = s.product_id WHERE a.mean_qty > 0) "
    f"SELECT sha256(concat('stockout_risk|{RUN_TS}|', product_id)) AS event_id, TIMESTAMP '{RUN_TS}' AS event_ts, "
    "'stockout_risk' AS event_type, product_id, CAST(1 AS DOUBLE) - least(cover, CAST(30 AS DOUBLE)) / CAST(30 AS DOUBLE) AS risk_score, "
    f"DATE '{RUN_TS[:10]}' + CAST(floor(cover) AS INTEGER) AS predicted_date, "
    f"CAST(days AS DOUBLE) / CAST(7 AS DOUBLE) AS confidence, DATE '{RUN_TS[:10]}' AS event_date FROM covered",
)
def stockout_risk(t: Tables) -> DataFrame:
    return forecast.stockout_risk(t.curated("fact_inventory_movements"), t.curated("fact_orders"), RUN_TS)


@query(
    "sla_violations",
    "SELECT vehicle_id AS vehicle_type, "
    + _REGION.format(id="vehicle_id", at=3)
    + " AS region, COUNT(*) AS deliveries, CAST(SUM(CASE WHEN actual_minutes > sla_minutes THEN 1 ELSE 0 END) AS BIGINT) AS violations, "
    "CAST(SUM(greatest(actual_minutes - sla_minutes, 0)) AS BIGINT) AS late_minutes, "
    "CAST(SUM(CASE WHEN actual_minutes > sla_minutes THEN 1 ELSE 0 END) AS DOUBLE) / CAST(COUNT(*) AS DOUBLE) AS violation_rate "
    "FROM raw_delivery_sla GROUP BY vehicle_id",
)
def sla_violations(t: Tables) -> DataFrame:
    return analytics.sla_violations(t.raw("raw_delivery_sla"), t.current("dim_vehicle", "vehicle_id"))


@query(
    "order_anomalies",
    "WITH daily AS (SELECT product_id, event_date, CAST(SUM(qty) AS BIGINT) AS qty FROM fact_orders GROUP BY product_id, event_date), "
    "sums AS (SELECT product_id, COUNT(*) AS n, SUM(qty) AS s, SUM(CAST(qty AS HUGEINT) * qty) AS ss "
    "FROM daily GROUP BY product_id), "
    "measured AS (SELECT d.product_id, d.event_date, d.qty, CAST(s AS DOUBLE) / CAST(n AS DOUBLE) AS mean_qty, "
    "sqrt(CAST(n * ss - s * s AS DOUBLE) / CAST(n * (n - 1) AS DOUBLE)) AS sd_qty "
    "FROM daily d JOIN sums USING (product_id) WHERE n > 1) "
    "SELECT * FROM measured WHERE sd_qty > 0 AND abs(CAST(qty AS DOUBLE) - mean_qty) > CAST(2 AS DOUBLE) * sd_qty",
)
def order_anomalies(t: Tables) -> DataFrame:
    return analytics.order_anomalies(t.curated("fact_orders"), deviations=2.0)


@query(
    "order_features",
    "SELECT f.event_id, f.order_id, f.product_id, f.warehouse_id, f.qty, f.event_date, "
    'CAST(day(f.event_date) AS INTEGER) AS "day", CAST(strftime(f.event_date, \'%W\') AS INTEGER) AS "week", '
    'CAST(month(f.event_date) AS INTEGER) AS "month", CAST(quarter(f.event_date) AS INTEGER) AS "quarter", '
    'CAST(year(f.event_date) AS INTEGER) AS "year", CAST(NULL AS VARCHAR) AS category, CAST(NULL AS INTEGER) AS unit_cost, '
    "CAST(f.event_date - p.first_seen AS INTEGER) AS product_age_days, "
    + _REGION.format(id="f.warehouse_id", at=4)
    + " AS region, CAST(NULL AS INTEGER) AS capacity FROM fact_orders f "
    "LEFT JOIN (SELECT product_id, MIN(event_date) AS first_seen FROM dim_product GROUP BY product_id) p "
    "ON f.product_id = p.product_id",
)
def order_features(t: Tables) -> DataFrame:
    return analytics.order_features(
        t.curated("fact_orders"),
        t.stored_current("dim_product", "product_id"),
        t.stored_current("dim_warehouse", "warehouse_id"),
    )
