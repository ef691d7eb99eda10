"""Dimension tables.

The ``dim_*`` functions give the reference shape: one row per source event (``dim_date``: one per date and source) with the
descriptive attributes as typed NULLs.  ``current`` gives one row per key, which is what joins need.

A raw table's ``event_date`` is the date of its own business time (``order_ts``, ``return_ts``, ...), so dates are taken from
it: the table is stored by that column, and neither the dates nor a date filter cost a read of the timestamps.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeops.functions.calendar import calendar_parts


def _observed_keys(raw: DataFrame, key: str, attributes: dict[str, str], source: str | None = None) -> DataFrame:
    column = F.col(source or key)
    return raw.where(column.isNotNull() & (column != "")).select(
        column.alias(key), *[F.lit(None).cast(kind).alias(name) for name, kind in attributes.items()], "event_date"
    )


def dim_product(raw_orders: DataFrame) -> DataFrame:
    return _observed_keys(raw_orders, "product_id", {"name": "string", "category": "string", "unit_cost": "int"})


def dim_warehouse(raw_orders: DataFrame) -> DataFrame:
    return _observed_keys(raw_orders, "warehouse_id", {"region": "string", "manager": "string", "capacity": "int"})


def dim_vehicle(raw_dispatch_logs: DataFrame) -> DataFrame:
    return _observed_keys(
        raw_dispatch_logs, "vehicle_id", {"type": "string", "capacity": "int", "current_location": "string"}
    )


def dim_error_code(raw_returns: DataFrame) -> DataFrame:
    """Codes are the reason codes of returns."""
    return _observed_keys(
        raw_returns, "error_code", {"description": "string", "severity_level": "string"}, source="reason_code"
    )


def dim_route(raw_route_updates: DataFrame) -> DataFrame:
    """Distinct routes per day seen."""
    return _observed_keys(raw_route_updates, "route_id", {"region_covered": "string", "avg_duration": "int"}).distinct()


def dim_date(raw_orders: DataFrame, raw_returns: DataFrame, raw_dispatch_logs: DataFrame) -> DataFrame:
    """Dates seen in orders, returns and dispatch logs, distinct per source (a date may occur up to three times)."""
    seen = [raw.select("event_date").distinct() for raw in (raw_orders, raw_returns, raw_dispatch_logs)]
    days = seen[0].unionAll(seen[1]).unionAll(seen[2]).where(F.col("event_date").isNotNull())
    date_id = F.col("event_date")
    return days.select(date_id.alias("date_id"), *calendar_parts(date_id), "event_date")


def seen_days(dim: DataFrame, key: str, attributes: list[str]) -> DataFrame:
    """First and last day of each key with each set of attributes; only dates are aggregated over the events, which hashes."""
    return dim.groupBy(key, *attributes).agg(F.min("event_date").alias("first_seen"), F.max("event_date").alias("last_seen"))


def current(dim: DataFrame, key: str) -> DataFrame:
    """One row per key: each attribute's value of the last day that has one (the largest of that day), first and last date seen.

    Grouping by key and attributes first leaves only dates to aggregate over the events, which hashes; the string maxima, which
    Spark computes by sorting, then see one row per distinct attribute set.
    """
    attributes = [c for c in dim.columns if c not in (key, "event_date")]
    return seen_days(dim, key, attributes).groupBy(key).agg(
        *[F.max_by(a, F.when(F.col(a).isNotNull(), F.struct("last_seen", a))).alias(a) for a in attributes],
        F.min("first_seen").alias("first_seen"),
        F.max("last_seen").alias("last_seen"),
    )
