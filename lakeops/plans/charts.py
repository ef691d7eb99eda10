"""Chart queries: metrics x group columns, or metrics over time, in order, whole unless the caller sets a limit."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Chart:
    """``metrics`` maps an output name to a SQL aggregate such as ``COUNT(*)``; ``dataset`` is the table charted."""

    title: str
    dataset: str
    metrics: tuple[tuple[str, str], ...]
    group_by: tuple[str, ...] = ()
    time_column: str | None = None
    grain: str | None = None  # of the time column: day, week, month, quarter or year; None takes its values as they are
    descending: bool = True
    row_limit: int | None = None


GRAINS = ("day", "week", "month", "quarter", "year")


def _limited(df: DataFrame, row_limit: int | None) -> DataFrame:
    return df if row_limit is None else df.limit(row_limit)


def chart_query(df: DataFrame, chart: Chart) -> DataFrame:
    """Grouped charts show the groups with the largest (or smallest) first metric; time charts run along the time column.

    Without ``row_limit`` every group or day is shown.  With one, order and limit become a top-k per task and a merge, not a global sort.
    """
    keys = [*([chart.time_column] if chart.time_column else []), *chart.group_by]
    if not keys:
        raise ValueError("a chart needs group columns or a time column")
    if chart.grain and chart.grain not in GRAINS:
        raise ValueError(f"unknown grain {chart.grain!r}")
    if chart.time_column and chart.grain:
        df = df.withColumn(chart.time_column, F.trunc(chart.time_column, chart.grain) if chart.grain != "day" else F.col(chart.time_column).cast("date"))
    metrics = [F.expr(sql).alias(name) for name, sql in chart.metrics]
    grouped = df.groupBy(*keys).agg(*metrics)
    if chart.time_column:
        return _limited(grouped.orderBy(*keys), chart.row_limit)
    first_metric = chart.metrics[0][0]
    order = F.desc(first_metric) if chart.descending else F.asc(first_metric)
    return _limited(grouped.orderBy(order, *keys), chart.row_limit)


_COUNT = (("count", "COUNT(*)"),)
_DELTA = (("sum_delta_qty", "SUM(delta_qty)"),)

# The dashboard's charts. "Returns by Warehouse" charts the mart's own total, not its row count.
CHARTS: dict[str, Chart] = {
    "orders_by_warehouse": Chart("Orders by Warehouse", "orders.fact_orders", _COUNT, ("warehouse_id",)),
    "returns_by_warehouse": Chart(
        "Returns by Warehouse",
        "analytics.returns_by_warehouse",
        (("total_returns", "SUM(total_returns)"),),
        ("warehouse_id",),
    ),
    "orders_by_product": Chart("Orders by Product", "orders.fact_orders", _COUNT, ("product_id",)),
    "daily_orders": Chart("Daily Orders", "orders.fact_orders", _COUNT, time_column="event_date"),
    "returns_by_reason": Chart("Returns by Reason", "returns.fact_returns", _COUNT, ("reason_code",)),
    "daily_returns": Chart("Daily Returns", "returns.fact_returns", _COUNT, time_column="event_date"),
    "inventory_by_product": Chart(
        "Inventory Movement by Product", "inventory.fact_inventory_movements", _DELTA, ("product_id",)
    ),
    "daily_inventory": Chart(
        "Daily Inventory Movement", "inventory.fact_inventory_movements", _DELTA, time_column="event_date"
    ),
    "dispatch_by_status": Chart("Dispatch Events by Status", "dispatch_logs.fact_dispatch_logs", _COUNT, ("status",)),
    "daily_dispatch": Chart("Daily Dispatch Events", "dispatch_logs.fact_dispatch_logs", _COUNT, time_column="event_date"),
    "dispatch_heatmap": Chart(
        "Dispatch Events Heatmap", "dispatch_logs.fact_dispatch_logs", _COUNT, ("vehicle_id", "status")
    ),
    "stockout_risk": Chart(
        "Avg Stockout Risk by Product",
        "ml_insights.raw_stockout_risk",
        (("avg_risk_score", "AVG(risk_score)"),),
        ("product_id",),
    ),
}
