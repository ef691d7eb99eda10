"""High-water marks: read only what is newer than the target table."""

from __future__ import annotations

import os
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeops.contracts import Table
from lakeops.sources import tables

LOOKBACK_ENV = "INCREMENTAL_LOOKBACK_HOURS"  # fixed value: the setting existing deployments use


def lookback_from_env() -> int:
    """Hours to re-read before the mark; 0 when unset, negative or not a number."""
    try:
        return max(0, int(os.environ.get(LOOKBACK_ENV, "0")))
    except ValueError:
        return 0


@dataclass(frozen=True)
class Mark:
    """The newest value of a table's mark column, as text, with its type."""

    value: str
    kind: str  # "timestamp_ntz" or "date"

    def cut(self, lookback_hours: int = 0) -> Column:
        """The instant after which rows are new; a constant to the optimizer."""
        point = F.lit(self.value).cast(self.kind).cast("timestamp_ntz")
        return point - F.make_dt_interval(F.lit(0), F.lit(lookback_hours)) if lookback_hours > 0 else point


def newest(rows: DataFrame, contract: Table) -> DataFrame:
    """The largest mark of some rows of a table, as one row."""
    return rows.agg(F.max(contract.mark).alias("mark"))


def high_water_mark(spark: SparkSession, warehouse: str, table: str | Table, but_load: str | None = None) -> Mark | None:
    """Largest mark of the stored table, without the rows of the load ``but_load``; None when there are no rows.

    ``event_date`` is the date of the mark column, so the largest mark lies in the newest date that has a mark.  Dates are
    folder names: one listing gives them, and only the newest folder's files are opened.  Dates that hold nothing but the load
    ``but_load`` are passed over by listing their loads, without a job; dates whose marks are all NULL cost a job each.
    """
    contract = tables.contract_of(table)
    if not tables.table_exists(spark, warehouse, contract):
        return None
    for date in tables.stored_dates(spark, warehouse, contract):
        if but_load is not None and set(tables.loads_of(spark, warehouse, contract, date)) <= {but_load}:
            continue
        rows = tables.scan_date(spark, warehouse, contract, date)
        if but_load is not None:
            rows = rows.where(F.col("load_id") != but_load)
        top = newest(rows, contract).select(F.col("mark").cast("string")).first()[0]
        if top is not None:
            return Mark(top, contract.schema[contract.mark].dataType.simpleString())
    return None


def newer_than(df: DataFrame, column: str, mark: Mark | None, lookback_hours: int = 0, ties: bool = False) -> DataFrame:
    """Rows newer than the mark minus the look-back (with ``ties``, also as new); all rows when there is no mark.

    The date predicate follows from the other one and is there for partition pruning.
    """
    if mark is None:
        return df
    cut = mark.cut(lookback_hours)
    if dict(df.dtypes)[column] == "date":  # a date is its midnight: later than the cut means a later day
        return df.where(F.col(column) >= cut.cast("date") if ties else F.col(column) > cut.cast("date"))
    newer = df.where(F.col(column) >= cut if ties else F.col(column) > cut)
    return newer.where(F.col("event_date") >= cut.cast("date")) if "event_date" in df.columns else newer
