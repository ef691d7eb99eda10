"""Marts kept up to date load by load: partial aggregates are stored, merged when read, and a replaced load takes its part back.

A mart's sources are stored tables.  Its partial aggregates stand in ``<warehouse>/_marts/<mart>/load_0=<load>/.../load_k=<load>``, a folder for each combination of a load
of every source: a mart over a join has the pairs of two loads as its own parts, so a new load of either side is joined with what the other side has, and nothing
else is computed again.  ``refresh`` reads only loads that are new, replaced or gone since the last one, and for a join the other side's keys that they hold.

A load's version is a digest of its files' names, which a writer never uses twice.  The versions that a mart contains are written after its parts, and parts of a
changed load are removed before new ones are written: a refresh that dies is repeated by the next one and counts nothing twice.  One refresh of a mart runs at a time; a
reader beside it may miss the loads being changed.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeops.contracts import Table
from lakeops.operators.bit_table import bit_table, key_hash, with_marks
from lakeops.sources import tables


@dataclass(frozen=True)
class Mart:
    """``partial(frames, changed)`` aggregates the sources, given with their loads as columns load_0, load_1, ...; ``changed`` is the number of the source that brings
    the change.  It returns the loads and the ``schema``'s columns; ``merge`` says how columns that are no keys combine: sum, min or max."""

    name: str
    sources: tuple[str | Table, ...]
    schema: str
    merge: dict[str, str]
    partial: Callable[[list[DataFrame], int], DataFrame]

    @property
    def loads(self) -> list[str]:
        return [f"load_{k}" for k in range(len(self.sources))]


def count_mart(name: str, source: str | Table, key: str, total: str, value: str = "1") -> Mart:
    """Per key (a column with its type) the sum of an SQL expression over one table."""
    column = key.split()[0]

    def partial(frames: list[DataFrame], changed: int) -> DataFrame:
        return frames[0].groupBy("load_0", column).agg(F.sum(F.expr(value)).cast("bigint").alias(total))

    return Mart(name, (source,), f"{key}, {total} bigint", {total: "sum"}, partial)


def returns_mart(name: str, returns: str | Table, orders: str | Table, day: str = "event_date") -> Mart:
    """Returns per warehouse of the returned order, with the date of the first one.

    Both sides are counted per order before they meet, and of the side that did not change only orders that the other side may hold are counted.
    """

    def partial(frames: list[DataFrame], changed: int) -> DataFrame:
        known = [f.where(F.col("order_id").isNotNull()) for f in frames]
        table = bit_table(known[changed].select(key_hash("order_id").alias("__h")), met=None)
        known[1 - changed] = with_marks(known[1 - changed], key_hash("order_id"), table).where("__met")
        returned = known[0].groupBy("order_id", "load_0").agg(F.count("*").alias("n_returns"), F.min(day).alias("event_date"))
        ordered = known[1].groupBy("order_id", "warehouse_id", "load_1").agg(F.count("*").alias("n_orders"))
        met = returned.join(ordered, "order_id")
        return met.groupBy("load_0", "load_1", "warehouse_id").agg(
            F.sum(F.col("n_returns") * F.col("n_orders")).alias("total_returns"), F.min("event_date").alias("event_date")
        )

    schema = "warehouse_id string, total_returns bigint, event_date date"
    return Mart(name, (returns, orders), schema, {"total_returns": "sum", "event_date": "min"}, partial)


MARTS = {
    m.name: m
    for m in (
        count_mart("orders_by_warehouse", "orders.fact_orders", "warehouse_id string", "total_orders"),
        count_mart("daily_orders", "orders.fact_orders", "event_date date", "total_orders"),
        count_mart("inventory_by_product", "inventory.fact_inventory_movements", "product_id string", "total_delta_qty", "delta_qty"),
        returns_mart("returns_by_warehouse", "returns.fact_returns", "orders.fact_orders"),
    )
}


def _path(warehouse: str, mart: Mart, part: str = "parts") -> str:
    return f"{warehouse.rstrip('/')}/_marts/{mart.name}/{part}"


def _stored_versions(spark: SparkSession, warehouse: str, mart: Mart) -> list[dict[str, int]]:
    """Per source the loads that the mart contains, with their versions."""
    found: list[dict[str, int]] = [{} for _ in mart.sources]
    path = _path(warehouse, mart, "versions")
    if tables.path_exists(spark, path):
        for row in spark.read.schema("source int, load string, version long").parquet(path).collect():  # a row per load
            found[row["source"]][row["load"]] = row["version"]
    return found


def _remove(spark: SparkSession, warehouse: str, mart: Mart, source: int, load: str) -> None:
    """The parts that a load of a source has a share in."""
    files, root = tables.folder(spark, _path(warehouse, mart))
    pattern = [("*" if k != source else f"{name}={tables.escaped(spark, load)}") for k, name in enumerate(mart.loads[: source + 1])]
    if files.exists(root):
        for status in files.globStatus(spark._jvm.org.apache.hadoop.fs.Path("/".join([root.toString(), *pattern]))) or []:
            files.delete(status.getPath(), True)


def _frame(spark: SparkSession, warehouse: str, source: str | Table, number: int, loads: set[str]) -> DataFrame:
    """A source's rows of some loads; the load filter prunes folders."""
    rows = tables.scan(spark, warehouse, source, keep_load_id=True).where(F.col("load_id").isin(sorted(loads)))
    return rows.withColumnRenamed("load_id", f"load_{number}")


def pending(spark: SparkSession, warehouse: str, mart: Mart) -> tuple[list[dict[str, int]], list[set[str]], list[set[str]]]:
    """Per source the versions there are, the loads that are new or replaced, and those that are gone."""
    there = [tables.load_versions(spark, warehouse, s) for s in mart.sources]
    held = _stored_versions(spark, warehouse, mart)
    changed = [{load for load, v in now.items() if before.get(load) != v} for now, before in zip(there, held, strict=True)]
    return there, changed, [set(before) - set(now) for now, before in zip(there, held, strict=True)]


def refresh(spark: SparkSession, warehouse: str, mart: Mart) -> list[set[str]]:
    """Bring the mart up to date; per source, the loads that were read as new."""
    there, changed, gone = pending(spark, warehouse, mart)
    if not any(changed) and not any(gone):
        return changed
    for number, loads in enumerate(zip(changed, gone, strict=True)):
        for load in sorted(set.union(*loads)):
            _remove(spark, warehouse, mart, number, load)
    parts = []
    for number, news in enumerate(changed):  # combinations whose first changed load is of this source
        loads = [set(there[k]) - changed[k] if k < number else news if k == number else set(there[k]) for k in range(len(there))]
        if all(loads):
            parts.append(mart.partial([_frame(spark, warehouse, s, k, loads[k]) for k, s in enumerate(mart.sources)], number))
    if parts:
        rows = reduce(DataFrame.unionByName, parts)
        writer = rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        writer.partitionBy(*mart.loads).parquet(_path(warehouse, mart))
    versions = [(k, load, v) for k, now in enumerate(there) for load, v in sorted(now.items())]
    spark.createDataFrame(versions, "source int, load string, version long").coalesce(1).write.mode("overwrite").parquet(_path(warehouse, mart, "versions"))
    return changed


def read(spark: SparkSession, warehouse: str, mart: Mart) -> DataFrame:
    """The mart as of its last refresh."""
    loads = ", ".join(f"{name} string" for name in mart.loads)
    path = _path(warehouse, mart)
    schema = f"{mart.schema}, {loads}"
    parts = spark.read.schema(schema).parquet(path) if tables.path_exists(spark, path) else spark.createDataFrame([], schema)
    keys = [c for c in parts.columns if c not in mart.merge and c not in mart.loads]
    return parts.groupBy(*keys).agg(*[F.call_function(how, F.col(c)).alias(c) for c, how in mart.merge.items()])
