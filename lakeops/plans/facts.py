"""Fact tables: projections of raw tables. Each function takes the raw frame and returns the fact's columns."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

ENVELOPE = ("event_id", "event_ts", "event_type")


def fact_orders(raw: DataFrame) -> DataFrame:
    return raw.select(*ENVELOPE, "order_id", "product_id", "warehouse_id", "order_ts", "qty", "event_date")


def fact_returns(raw: DataFrame) -> DataFrame:
    return raw.select(*ENVELOPE, "return_id", "order_id", "return_ts", "reason_code", "event_date")


def fact_inventory_movements(raw: DataFrame) -> DataFrame:
    return raw.select(
        *ENVELOPE,
        "product_id",
        F.col("event_ts").cast("timestamp_ntz").alias("movement_ts"),
        "delta_qty",
        F.col("source_type").alias("movement_type"),
        "event_date",
    )


def fact_order_errors(raw: DataFrame) -> DataFrame:
    """``details`` is optional: NULL when the raw table does not carry it."""
    details = F.col("details") if "details" in raw.columns else F.lit(None)
    return raw.select(
        *ENVELOPE, "error_id", "order_id", "error_code", "error_ts", details.cast("string").alias("details"), "event_date"
    )


def fact_dispatch_logs(raw: DataFrame) -> DataFrame:
    return raw.select(*ENVELOPE, "dispatch_id", "vehicle_id", "status", F.col("eta").alias("eta_ts"), "event_date")


def fact_vehicle_routes(raw: DataFrame) -> DataFrame:
    return raw.select(*ENVELOPE, "route_id", "status", "updated_ts", "event_date")


def fact_forecast_demand(raw: DataFrame) -> DataFrame:
    return raw.select(*ENVELOPE, "product_id", "region", "forecast_ts", "forecast_qty", "event_date")


def fact_stockout_risks(raw: DataFrame) -> DataFrame:
    return raw.select(*ENVELOPE, "product_id", "risk_score", "predicted_date", "confidence", "event_date")
