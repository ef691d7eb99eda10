"""Current dimensions as stored state: new loads are merged into it, nothing else is read.

The state of a dimension has one row per key: first and last day seen, and each attribute with the last day that had a value for it.  It stands in
``<warehouse>/_current/<dimension>/state/v=<n>`` beside ``loads/v=<n>``, the loads that it contains with their versions.  ``update`` reduces the new loads to the same
form and joins both on the key; the loads' record is written last and names the state that counts, so an update that dies changes nothing and is repeated by the next
one.  A maximum cannot be taken back: if a load was replaced or is gone, the state is built again from the whole table.  One update of a dimension runs at a time; the
state before the last one stays for readers.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeops.contracts import Table
from lakeops.plans import dims
from lakeops.sources import tables


def _path(warehouse: str, contract: Table, part: str, version: int | None = None) -> str:
    return f"{warehouse.rstrip('/')}/_current/{contract.short_name}/{part}" + ("" if version is None else f"/v={version}")


def _attributes(contract: Table, key: str) -> list[str]:
    return [c for c in contract.column_names if c not in (key, "event_date")]


def reduced(dim: DataFrame, key: str, attributes: list[str]) -> DataFrame:
    """One row per key of a dimension's rows: key, per attribute its last value and the day that had it, first_seen, last_seen."""
    seen = dims.seen_days(dim, key, attributes)
    last = {a: F.max(F.when(F.col(a).isNotNull(), F.struct(F.col("last_seen").alias("day"), F.col(a).alias("value")))).alias(f"__{a}") for a in attributes}
    rows = seen.groupBy(key).agg(*last.values(), F.min("first_seen").alias("first_seen"), F.max("last_seen").alias("last_seen"))
    parts = [c for a in attributes for c in (F.col(f"__{a}.value").alias(a), F.col(f"__{a}.day").alias(f"{a}__day"))]
    return rows.select(key, *parts, "first_seen", "last_seen")


def merged(state: DataFrame, delta: DataFrame, key: str, attributes: list[str]) -> DataFrame:
    """Two reduced frames as one: one row per key on each side, so a join on the key."""
    s, d = state.alias("s"), delta.alias("d")

    def pair(side: str, a: str):
        return F.when(F.col(f"{side}.{a}__day").isNotNull(), F.struct(F.col(f"{side}.{a}__day").alias("day"), F.col(f"{side}.{a}").alias("value")))

    both = s.join(d, F.col(f"s.{key}").eqNullSafe(F.col(f"d.{key}")), "full_outer")
    last = [F.greatest(pair("s", a), pair("d", a)).alias(f"__{a}") for a in attributes]
    first_seen, last_seen = F.least("s.first_seen", "d.first_seen"), F.greatest("s.last_seen", "d.last_seen")
    rows = both.select(F.coalesce(f"s.{key}", f"d.{key}").alias(key), *last, first_seen.alias("first_seen"), last_seen.alias("last_seen"))
    parts = [c for a in attributes for c in (F.col(f"__{a}.value").alias(a), F.col(f"__{a}.day").alias(f"{a}__day"))]
    return rows.select(key, *parts, "first_seen", "last_seen")


def _held(spark: SparkSession, warehouse: str, contract: Table) -> tuple[int, dict[str, int]]:
    """The number of the state that counts (0: none) and the versions of the loads in it."""
    root = _path(warehouse, contract, "loads")
    numbers = [int(n) for n in tables.partition_values(spark, root, "v")] if tables.path_exists(spark, root) else []
    whole = [n for n in numbers if tables.path_exists(spark, f"{root}/v={n}/_SUCCESS")]
    if not whole:
        return 0, {}
    rows = spark.read.schema("load string, version long").parquet(f"{root}/v={max(whole)}").collect()  # a row per load
    return max(whole), {r["load"]: r["version"] for r in rows}


def delta(spark: SparkSession, warehouse: str, table: str, loads: set[str]) -> DataFrame:
    """The dimension's rows of some loads; the load filter prunes folders."""
    return tables.scan(spark, warehouse, table, keep_load_id=True).where(F.col("load_id").isin(sorted(loads))).drop("load_id")


def update(spark: SparkSession, warehouse: str, table: str, key: str) -> tuple[str, set[str]]:
    """Bring the state of a stored dimension up to date: what was done ("nothing", "merged" or "rebuilt") and the loads read."""
    contract = tables.contract_of(table)
    attributes = _attributes(contract, key)
    there = tables.load_versions(spark, warehouse, contract)
    number, held = _held(spark, warehouse, contract)
    if number and there == held:
        return "nothing", set()
    kept = number and all(there.get(load) == version for load, version in held.items())
    news = set(there) - set(held) if kept else set(there)
    rows = reduced(delta(spark, warehouse, table, news), key, attributes) if news else reduced(spark.createDataFrame([], contract.schema), key, attributes)
    if kept:
        rows = merged(_state(spark, warehouse, contract, key, number), rows, key, attributes)
    rows.write.mode("overwrite").parquet(_path(warehouse, contract, "state", number + 1))
    versions = spark.createDataFrame(sorted(there.items()), "load string, version long")
    versions.coalesce(1).write.mode("overwrite").parquet(_path(warehouse, contract, "loads", number + 1))
    for part in ("loads", "state"):
        tables.remove(spark, _path(warehouse, contract, part, number - 1))
    return "merged" if kept else "rebuilt", news


def _state(spark: SparkSession, warehouse: str, contract: Table, key: str, number: int) -> DataFrame:
    types = {f.name: f.dataType.simpleString() for f in contract.schema.fields}
    columns = [f"`{key}` {types[key]}", *[f"`{a}` {types[a]}, `{a}__day` date" for a in _attributes(contract, key)], "first_seen date, last_seen date"]
    return spark.read.schema(", ".join(columns)).parquet(_path(warehouse, contract, "state", number))


def read(spark: SparkSession, warehouse: str, table: str, key: str) -> DataFrame:
    """One row per key as of the last update: key, attributes, first_seen, last_seen."""
    contract = tables.contract_of(table)
    number, _ = _held(spark, warehouse, contract)
    if not number:
        return reduced(spark.createDataFrame([], contract.schema), key, _attributes(contract, key)).select(key, *_attributes(contract, key), "first_seen", "last_seen")
    return _state(spark, warehouse, contract, key, number).select(key, *_attributes(contract, key), "first_seen", "last_seen")
