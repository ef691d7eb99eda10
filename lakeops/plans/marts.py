"""Dashboard marts over the fact tables.

Every aggregate combines on the map side, so a key with a large share of the rows costs one partial row per task.  Ordered
results carry the group key as a tie-break, which makes them repeatable.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakeops.operators.joins import returns_per_order


def _total(df: DataFrame, keys: list[str], value: Column, alias: str) -> DataFrame:
    return df.groupBy(*keys).agg(value.alias(alias))


def _largest_first(df: DataFrame, keys: list[str], value: Column, alias: str) -> DataFrame:
    return _total(df, keys, value, alias).orderBy(F.desc(alias), *keys)


def orders_by_warehouse(fact_orders: DataFrame) -> DataFrame:
    return _largest_first(fact_orders, ["warehouse_id"], F.count("*"), "total_orders")


def orders_by_product(fact_orders: DataFrame) -> DataFrame:
    return _largest_first(fact_orders, ["product_id"], F.count("*"), "total_orders")


def daily_orders(fact_orders: DataFrame) -> DataFrame:
    return _total(fact_orders, ["event_date"], F.count("*"), "total_orders").orderBy("event_date")


def returns_by_warehouse_mart(fact_returns: DataFrame, fact_orders: DataFrame) -> DataFrame:
    """Returns per warehouse of the returned order, with the date of the first one."""
    return (
        returns_per_order(fact_returns, fact_orders)
        .groupBy("warehouse_id")
        .agg(F.sum("total_returns").alias("total_returns"), F.min("event_date").alias("event_date"))
    )


def returns_by_warehouse(fact_returns: DataFrame, fact_orders: DataFrame) -> DataFrame:
    per_order = returns_per_order(fact_returns, fact_orders)
    return _largest_first(per_order, ["warehouse_id"], F.sum("total_returns"), "total_returns")


def returns_by_reason(fact_returns: DataFrame) -> DataFrame:
    return _largest_first(fact_returns, ["reason_code"], F.count("*"), "total_returns")


def daily_returns(fact_returns: DataFrame) -> DataFrame:
    return _total(fact_returns, ["event_date"], F.count("*"), "total_returns").orderBy("event_date")


def inventory_by_product(fact_inventory: DataFrame) -> DataFrame:
    return _largest_first(fact_inventory, ["product_id"], F.sum("delta_qty"), "total_delta_qty")


def daily_inventory(fact_inventory: DataFrame) -> DataFrame:
    return _total(fact_inventory, ["event_date"], F.sum("delta_qty"), "total_delta_qty").orderBy("event_date")


def dispatch_by_status(fact_dispatch: DataFrame) -> DataFrame:
    return _largest_first(fact_dispatch, ["status"], F.count("*"), "event_count")


def dispatch_by_vehicle_and_status(fact_dispatch: DataFrame) -> DataFrame:
    return _largest_first(fact_dispatch, ["vehicle_id", "status"], F.count("*"), "event_count")


def daily_dispatch(fact_dispatch: DataFrame) -> DataFrame:
    return _total(fact_dispatch, ["event_date"], F.count("*"), "count").orderBy("event_date")


def average_stockout_risk(stockout_risk: DataFrame) -> DataFrame:
    return _largest_first(stockout_risk, ["product_id"], F.avg("risk_score"), "avg_risk_score")
