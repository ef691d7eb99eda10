"""Demand forecast and stock-out risk, per product, as raw prediction rows."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lakeops.functions.ids import derived_id, region_of
from lakeops.sources import tables

WINDOW_DAYS = 7
HORIZON_DAYS = 30


def _run_time(run_ts: str) -> Column:
    return F.lit(run_ts).cast("timestamp_ntz")


def demand_history(fact_orders: DataFrame, by_region: bool = False) -> DataFrame:
    """Ordered quantity per product (and region of the warehouse) and day."""
    region = F.coalesce(region_of(F.col("warehouse_id")), F.lit("unknown")) if by_region else F.lit("global")
    return fact_orders.groupBy("product_id", region.alias("region"), "event_date").agg(F.sum("qty").alias("qty"))


def moving_average(history: DataFrame, window_days: int = WINDOW_DAYS) -> DataFrame:
    """Mean of the last ``window_days`` daily totals of each product and region; no history, no row.

    The history is one row per day, so a product's window is short however many orders it has.
    """
    latest_first = Window.partitionBy("product_id", "region").orderBy(F.desc("event_date"))
    last_days = history.withColumn("day_rank", F.row_number().over(latest_first)).where(F.col("day_rank") <= window_days)
    return last_days.groupBy("product_id", "region").agg(
        F.avg("qty").alias("mean_qty"), F.count("*").alias("days"), F.max("event_date").alias("last_date")
    )


def dense_history(history: DataFrame, through: Column) -> DataFrame:
    """The history with a row of 0 for each day without orders, from a product's first day to ``through``.

    Each row fills the gap up to the next one itself, so there is no join with a calendar, and a product has rows for its own days only.
    """
    by_day = Window.partitionBy("product_id", "region").orderBy("event_date")
    until = F.greatest(F.date_sub(F.coalesce(F.lead("event_date").over(by_day), F.date_add(through, 1)), 1), F.col("event_date"))
    filled = history.where(F.col("event_date").isNotNull()).withColumn("until", until).withColumn("day", F.explode(F.sequence("event_date", "until")))
    qty = F.when(F.col("day") == F.col("event_date"), F.col("qty")).otherwise(F.lit(0))
    return filled.select("product_id", "region", F.col("day").alias("event_date"), qty.alias("qty"))


def demand_forecast(
    fact_orders: DataFrame, run_ts: str, window_days: int = WINDOW_DAYS, by_region: bool = False, calendar: bool = False
) -> DataFrame:
    """Rows for ``ml_insights.raw_demand_forecast``; the quantity is the mean rounded half to even.

    The mean is that of a product's last days with orders, or with ``calendar`` that of the last days up to the newest order of all, on which a day
    without orders counts as 0.  Ids and times come from the arguments, so a repeated run writes the same rows.
    """
    now = _run_time(run_ts)
    history = demand_history(fact_orders, by_region)
    if calendar:
        newest = F.lit(fact_orders.agg(F.max("event_date").alias("d")).first()["d"]).cast("date")  # one row
        first = F.date_sub(newest, window_days - 1)
        recent = history.where(F.col("event_date") >= first)  # a product without recent orders keeps its last day, to be filled from there
        last = history.where(F.col("event_date") < first).groupBy("product_id", "region").agg(F.max("event_date").alias("event_date"), F.lit(0).cast("bigint").alias("qty"))
        history = dense_history(recent.unionByName(last.select(*recent.columns)), newest).where(F.col("event_date") >= first)
    averages = moving_average(history, window_days)
    return averages.select(
        derived_id(F.lit("forecast_demand"), F.lit(run_ts), F.col("product_id"), F.col("region")).alias("event_id"),
        now.alias("event_ts"),
        F.lit("forecast_demand").alias("event_type"),
        "product_id",
        "region",
        now.alias("forecast_ts"),
        F.bround("mean_qty").cast("bigint").alias("forecast_qty"),
        now.cast("date").alias("event_date"),
    )


def stockout_risk(
    fact_inventory: DataFrame,
    fact_orders: DataFrame,
    run_ts: str,
    window_days: int = WINDOW_DAYS,
    horizon_days: int = HORIZON_DAYS,
) -> DataFrame:
    """Rows for ``ml_insights.raw_stockout_risk``: how soon the net stock of a product runs out at its forecast demand.

    Days of cover are net stock (sum of movements, at least 0) over mean daily demand.  The risk falls from 1 at no cover to 0
    at ``horizon_days``; the predicted date is the run date plus the whole days of cover, however far off (NULL beyond the
    year 9999); the confidence
    is the share of the averaging window that has data.  Both join sides hold one row per product.
    """
    now = _run_time(run_ts)
    stock = fact_inventory.groupBy("product_id").agg(F.sum("delta_qty").alias("net_qty"))
    demand = moving_average(demand_history(fact_orders), window_days).where(F.col("mean_qty") > 0)
    joined = demand.join(stock, "product_id", "left")
    available = F.greatest(F.coalesce("net_qty", F.lit(0)), F.lit(0)).cast("double")
    cover = available / F.col("mean_qty")
    bounded = F.least(F.col("cover"), F.lit(float(horizon_days)))
    last_day = F.datediff(F.lit("9999-12-31").cast("date"), now.cast("date"))
    return joined.withColumn("cover", cover).select(
        derived_id(F.lit("stockout_risk"), F.lit(run_ts), F.col("product_id")).alias("event_id"),
        now.alias("event_ts"),
        F.lit("stockout_risk").alias("event_type"),
        "product_id",
        (F.lit(1.0) - bounded / F.lit(float(horizon_days))).alias("risk_score"),
        F.when(F.col("cover") <= last_day, F.date_add(now.cast("date"), F.floor(F.least("cover", last_day)).cast("int"))).alias("predicted_date"),
        (F.col("days").cast("double") / F.lit(float(window_days))).alias("confidence"),
        now.cast("date").alias("event_date"),
    )


def _load_id(kind: str, run_ts: str) -> str:
    """A load named after the run, so that repeating the run replaces its rows."""
    return f"{kind}-{re.sub('[^0-9]', '', run_ts)}"


def write_demand_forecast(
    spark: SparkSession, warehouse: str, run_ts: str, window_days: int = WINDOW_DAYS, by_region: bool = False
) -> None:
    """Forecast from the stored orders and append to ``ml_insights.raw_demand_forecast``."""
    orders = tables.scan(spark, warehouse, "orders.fact_orders")
    rows = demand_forecast(orders, run_ts, window_days, by_region)
    kind = "forecast_region" if by_region else "forecast"
    tables.append(rows, warehouse, "ml_insights.raw_demand_forecast", _load_id(kind, run_ts))


def write_stockout_risk(
    spark: SparkSession,
    warehouse: str,
    run_ts: str,
    window_days: int = WINDOW_DAYS,
    horizon_days: int = HORIZON_DAYS,
) -> None:
    """Score the stored inventory and orders and append to ``ml_insights.raw_stockout_risk``."""
    inventory = tables.scan(spark, warehouse, "inventory.fact_inventory_movements")
    orders = tables.scan(spark, warehouse, "orders.fact_orders")
    rows = stockout_risk(inventory, orders, run_ts, window_days, horizon_days)
    tables.append(rows, warehouse, "ml_insights.raw_stockout_risk", _load_id("stockout", run_ts))
