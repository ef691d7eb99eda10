"""Incremental curation jobs: raw tables in, newer rows appended to the fact or dimension table."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeops.contracts import TABLES
from lakeops.operators import dedupe, incremental
from lakeops.plans import dims, facts
from lakeops.sources import tables

_ORDERS, _RETURNS, _DISPATCH = "orders.raw_orders", "returns.raw_returns", "dispatch_logs.raw_dispatch_logs"


@dataclass(frozen=True)
class Job:
    """``target`` = ``build(sources)``, kept up to date by the target's mark column.

    A ``narrow`` job only filters and projects, so its rows keep the by-date layout of the source.
    """

    target: str
    sources: tuple[str, ...]
    build: Callable[..., DataFrame]
    narrow: bool = True


JOBS: dict[str, Job] = {
    job.target.split(".")[1]: job
    for job in (
        Job("orders.fact_orders", (_ORDERS,), facts.fact_orders),
        Job("returns.fact_returns", (_RETURNS,), facts.fact_returns),
        Job(
            "inventory.fact_inventory_movements",
            ("inventory.raw_inventory_movements",),
            facts.fact_inventory_movements,
        ),
        Job("order_errors.fact_order_errors", ("order_errors.raw_order_errors",), facts.fact_order_errors),
        Job("dispatch_logs.fact_dispatch_logs", (_DISPATCH,), facts.fact_dispatch_logs),
        Job("logistics_core.fact_vehicle_routes", ("logistics_core.raw_route_updates",), facts.fact_vehicle_routes),
        Job("ml_insights.fact_forecast_demand", ("ml_insights.raw_demand_forecast",), facts.fact_forecast_demand),
        Job("ml_insights.fact_stockout_risks", ("ml_insights.raw_stockout_risk",), facts.fact_stockout_risks),
        Job("dimensions.dim_product", (_ORDERS,), dims.dim_product),
        Job("dimensions.dim_warehouse", (_ORDERS,), dims.dim_warehouse),
        Job("dimensions.dim_vehicle", (_DISPATCH,), dims.dim_vehicle),
        Job("dimensions.dim_error_code", (_RETURNS,), dims.dim_error_code),
        Job("dimensions.dim_date", (_ORDERS, _RETURNS, _DISPATCH), dims.dim_date, narrow=False),
        Job("dimensions.dim_route", ("logistics_core.raw_route_updates",), dims.dim_route, narrow=False),
    )
}


def newer_rows(
    built: DataFrame,
    target: str,
    mark: incremental.Mark | None,
    lookback_hours: int = 0,
    stored: DataFrame | None = None,
    stored_scope: str = "window",
) -> DataFrame:
    """The rows of ``built`` to append to ``target``.

    Without ``stored``: every row strictly newer than the mark minus the look-back (a look-back re-reads rows, so it repeats
    them).  With ``stored``: rows as new as that too, one per key, and only keys not stored yet; of a table without a key, which
    may hold equal rows, as many of each as are not stored yet on the dates read.  A re-read event has the date it was stored under,
    so ``stored_scope="window"`` looks only at the stored dates the look-back covers; ``"table"`` looks at all of them, which
    also catches another event that reuses an old id.
    """
    contract = TABLES[target]
    if stored is None:
        return incremental.newer_than(built, contract.mark, mark, lookback_hours)
    rows = incremental.newer_than(built, contract.mark, mark, lookback_hours, ties=True)
    if contract.key is None:
        rows = tables.conform_to(rows, contract)
        return rows if mark is None else rows.exceptAll(incremental.newer_than(stored, contract.mark, mark, lookback_hours, ties=True))
    if mark is None:
        return dedupe.one_row_per(rows, contract.key)
    if stored_scope == "window":
        stored = stored.where(F.col("event_date") >= mark.cut(lookback_hours).cast("date"))
    return dedupe.new_once(rows, stored, contract.key)


def run(
    spark: SparkSession,
    warehouse: str,
    name: str,
    mode: str = "idempotent",
    lookback_hours: int | None = None,
    stored_scope: str = "window",
    load_id: str | None = None,
) -> str:
    """Bring one curated table up to date and return the ``load_id`` of the rows appended.

    ``mode="idempotent"`` re-reads the look-back and appends only what is not stored yet, so it picks up ties and late rows and
    repairs a load that was cut off.  ``mode="strict"`` appends rows newer than the mark and repeats a look-back.

    A ``load_id`` that was used before names the same load again, as a scheduler's retry does: its earlier rows do not count as
    stored, neither for the mark, and are replaced by all that this run finds.
    """
    if mode not in ("strict", "idempotent"):
        raise ValueError(f"unknown mode {mode!r}")
    job = JOBS[name]
    hours = incremental.lookback_from_env() if lookback_hours is None else lookback_hours
    mark = incremental.high_water_mark(spark, warehouse, job.target, but_load=load_id)
    sources = [tables.scan(spark, warehouse, s) for s in job.sources]
    built = job.build(*sources)
    idempotent = mode == "idempotent"
    stored = None
    if idempotent and tables.table_exists(spark, warehouse, job.target):
        stored = tables.scan(spark, warehouse, job.target, keep_load_id=True)
        stored = (stored if load_id is None else stored.where(F.col("load_id") != load_id)).drop("load_id")
    elif idempotent:
        stored = spark.createDataFrame([], TABLES[job.target].schema)
    rows = newer_rows(built, job.target, mark, hours, stored, stored_scope)
    return tables.append(rows, warehouse, job.target, load_id, by_date=job.narrow and not idempotent)
