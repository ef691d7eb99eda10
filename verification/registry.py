"""A query = a function of the test tables, plus the SQL a checking engine runs on the same tables."""

from __future__ import annotations

import re
from collections.abc import Callable
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession

from lakeops.plans import dims
from lakeops.plans.curate import JOBS
from lakeops.session import computed_once, shared_dir
from lakeops.sources import testdata

# Raw tables and the CTEs below may be used in a query's SQL by name.
CTES: dict[str, str] = {name: derived.sql() for name, derived in testdata.RAW.items()}
CTES |= {
    "fact_orders": "SELECT event_id, event_ts, event_type, order_id, product_id, warehouse_id, order_ts, qty, event_date FROM raw_orders",
    "fact_returns": "SELECT event_id, event_ts, event_type, return_id, order_id, return_ts, reason_code, event_date FROM raw_returns",
    "fact_inventory_movements": (
        "SELECT event_id, event_ts, event_type, product_id, CAST(event_ts AS TIMESTAMP) AS movement_ts, delta_qty, "
        "source_type AS movement_type, event_date FROM raw_inventory_movements"
    ),
    "fact_order_errors": (
        "SELECT event_id, event_ts, event_type, error_id, order_id, error_code, error_ts, CAST(NULL AS VARCHAR) AS details, "
        "event_date FROM raw_order_errors"
    ),
    "fact_dispatch_logs": (
        "SELECT event_id, event_ts, event_type, dispatch_id, vehicle_id, status, eta AS eta_ts, event_date FROM raw_dispatch_logs"
    ),
    "fact_vehicle_routes": "SELECT event_id, event_ts, event_type, route_id, status, updated_ts, event_date FROM raw_route_updates",
    "fact_forecast_demand": (
        "SELECT event_id, event_ts, event_type, product_id, region, forecast_ts, forecast_qty, event_date FROM raw_demand_forecast"
    ),
    "fact_stockout_risks": (
        "SELECT event_id, event_ts, event_type, product_id, risk_score, predicted_date, confidence, event_date FROM raw_stockout_risk"
    ),
    "dim_product": (
        "SELECT product_id, CAST(NULL AS VARCHAR) AS name, CAST(NULL AS VARCHAR) AS category, CAST(NULL AS INTEGER) AS unit_cost, "
        "CAST(order_ts AS DATE) AS event_date FROM raw_orders WHERE product_id IS NOT NULL AND product_id <> ''"
    ),
    "dim_warehouse": (
        "SELECT warehouse_id, CAST(NULL AS VARCHAR) AS region, CAST(NULL AS VARCHAR) AS manager, CAST(NULL AS INTEGER) AS capacity, "
        "CAST(order_ts AS DATE) AS event_date FROM raw_orders WHERE warehouse_id IS NOT NULL AND warehouse_id <> ''"
    ),
    "dim_vehicle": (
        'SELECT vehicle_id, CAST(NULL AS VARCHAR) AS "type", CAST(NULL AS INTEGER) AS capacity, '
        "CAST(NULL AS VARCHAR) AS current_location, CAST(event_ts AS DATE) AS event_date FROM raw_dispatch_logs "
        "WHERE vehicle_id IS NOT NULL AND vehicle_id <> ''"
    ),
    "dim_error_code": (
        "SELECT reason_code AS error_code, CAST(NULL AS VARCHAR) AS description, CAST(NULL AS VARCHAR) AS severity_level, "
        "CAST(return_ts AS DATE) AS event_date FROM raw_returns WHERE reason_code IS NOT NULL AND reason_code <> ''"
    ),
    "dim_route": (
        "SELECT DISTINCT route_id, CAST(NULL AS VARCHAR) AS region_covered, CAST(NULL AS INTEGER) AS avg_duration, "
        "CAST(updated_ts AS DATE) AS event_date FROM raw_route_updates WHERE route_id IS NOT NULL AND route_id <> ''"
    ),
    "all_dates": (
        "SELECT DISTINCT CAST(order_ts AS DATE) AS date_id FROM raw_orders UNION ALL "
        "SELECT DISTINCT CAST(return_ts AS DATE) AS date_id FROM raw_returns UNION ALL "
        "SELECT DISTINCT CAST(event_ts AS DATE) AS date_id FROM raw_dispatch_logs"
    ),
    "dim_date": (
        'SELECT date_id, CAST(day(date_id) AS INTEGER) AS "day", CAST(strftime(date_id, \'%W\') AS INTEGER) AS "week", '
        'CAST(month(date_id) AS INTEGER) AS "month", CAST(quarter(date_id) AS INTEGER) AS "quarter", '
        'CAST(year(date_id) AS INTEGER) AS "year", date_id AS event_date FROM all_dates WHERE date_id IS NOT NULL'
    ),
}


def complete(sql: str) -> str:
    """``sql`` with the CTEs it names, directly or through another CTE, put in front of it."""
    needed: list[str] = []

    def visit(text: str) -> None:
        for name in CTES:
            if name not in needed and re.search(rf"\b{name}\b", text):
                visit(CTES[name])
                if name not in needed:
                    needed.append(name)

    visit(sql)
    if not needed:
        return sql
    front = ", ".join(f"{n} AS ({CTES[n]})" for n in needed)
    body = sql.strip()
    return f"WITH {front}, {body[5:]}" if body.upper().startswith("WITH ") else f"WITH {front} {body}"


class Tables:
    """The test tables of one folder as raw, fact and dimension frames."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir

    def raw(self, name: str) -> DataFrame:
        return testdata.raw_table(self.spark, self.sf_dir, name)

    def curated(self, name: str) -> DataFrame:
        job = JOBS[name]
        return job.build(*[self.raw(s.split(".")[1]) for s in job.sources])

    def current(self, name: str, key: str) -> DataFrame:
        return dims.current(self.curated(name), key)

    def stored_current(self, name: str, key: str, *columns: str) -> DataFrame:
        """The one-row-per-key dimension, computed once: a join measures it before it reads it."""
        current = self.current(name, key)
        return computed_once(current.select(key, *columns) if columns else current)

    @cached_property
    def scratch(self) -> str:
        """A new folder of this run in the shared checkpoint folder."""
        return shared_dir(self.spark)


Query = Callable[[Tables], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None, function: Query) -> None:
    if name in QUERIES:
        raise ValueError(f"query {name} is registered twice")
    QUERIES[name] = function
    if sql is not None:
        ORACLE[name] = complete(sql)


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def add(function: Query) -> Query:
        register(name, sql, function)
        return function

    return add
