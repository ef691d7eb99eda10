"""Small loads of a date merged into few files.

Loads of a date that are smaller than ``small_bytes`` together are packed into bins of about ``target_bytes``, in the order of their names; each bin of two loads or more
becomes one load, named after what it holds.  Rows and high-water marks stay the same.  Merged loads can no longer be replaced by their old names: merge loads whose
retries are over.

A plain folder has no atomic swap, so a merge keeps a journal: merged rows are written to a hidden folder first, then the list of bins; then bin by bin the merged
load is moved into its date and the loads it replaces are deleted.  ``finish`` carries out what a journal lists and is harmless to repeat; ``merge_small_loads`` calls it
first, so a merge that died is completed by the next one.  While a bin is swapped, readers may see its rows twice.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lakeops.contracts import Table
from lakeops.sources import tables

PREFIX = "merged-"


def _place(warehouse: str, contract: Table, part: str) -> str:
    module, name = contract.name.split(".", 1)
    return f"{warehouse.rstrip('/')}/_merging/{module}/{name}/{part}"


def load_sizes(spark: SparkSession, warehouse: str, table: str | Table) -> DataFrame:
    """(event_date, load_id, files, bytes) of each load's share of a date, from the files' own sizes."""
    contract = tables.contract_of(table)
    files = tables.scan(spark, warehouse, contract, keep_load_id=True).select("event_date", "load_id", "_metadata.file_path", "_metadata.file_size").distinct()
    return files.groupBy("event_date", "load_id").agg(F.count("*").alias("files"), F.sum("file_size").alias("bytes"))


def bins(sizes: DataFrame, target_bytes: int, small_bytes: int) -> DataFrame:
    """(event_date, load_id, merged): the small loads of each date and the load each becomes part of."""
    before = Window.partitionBy("event_date").orderBy("load_id").rowsBetween(Window.unboundedPreceding, -1)
    small = sizes.where(F.col("bytes") < small_bytes).withColumn("bin", F.floor(F.coalesce(F.sum("bytes").over(before), F.lit(0)) / target_bytes))
    held = Window.partitionBy("event_date", "bin")
    named = small.withColumn("members", F.collect_list("load_id").over(held)).where(F.size("members") > 1)
    return named.select("event_date", "load_id", F.concat(F.lit(PREFIX), F.sha2(F.array_join(F.array_sort("members"), "\n"), 256).substr(1, 24)).alias("merged"))


def merge_small_loads(spark: SparkSession, warehouse: str, table: str | Table, target_bytes: int = 256 << 20, small_bytes: int = 64 << 20) -> int:
    """Merge, and return how many loads of dates were replaced."""
    contract = tables.contract_of(table)
    finish(spark, warehouse, contract)
    if not tables.table_exists(spark, warehouse, contract):
        return 0
    rows, journal = _place(warehouse, contract, "rows"), _place(warehouse, contract, "journal")
    tables.remove(spark, rows)
    plan = bins(load_sizes(spark, warehouse, contract), target_bytes, small_bytes)
    listed = plan.collect()  # a row per folder to delete
    if not listed:
        return 0
    plan = F.broadcast(spark.createDataFrame(listed, plan.schema))
    scan = tables.scan(spark, warehouse, contract, keep_load_id=True)
    same = scan["event_date"].eqNullSafe(plan["event_date"]) & (scan["load_id"] == plan["load_id"])
    moved = scan.join(plan, same).select(*[scan[c] for c in contract.column_names], F.col("merged").alias("load_id"))
    order = [c for c in (*tables.PARTITION_COLUMNS, contract.mark) if c]
    sorted_rows = moved.repartition("event_date", "load_id").sortWithinPartitions(*dict.fromkeys(order))  # a bin has about target_bytes
    sorted_rows.write.mode("overwrite").partitionBy(*tables.PARTITION_COLUMNS).parquet(rows)
    spark.createDataFrame(listed, "event_date date, load_id string, merged string").coalesce(1).write.mode("overwrite").parquet(journal)
    finish(spark, warehouse, contract)
    return len(listed)


def finish(spark: SparkSession, warehouse: str, table: str | Table) -> None:
    """Carry out the journal of a merge, if there is one, and remove it."""
    contract = tables.contract_of(table)
    rows, journal = _place(warehouse, contract, "rows"), _place(warehouse, contract, "journal")
    if not tables.path_exists(spark, f"{journal}/_SUCCESS"):
        return
    root = tables.table_path(warehouse, contract.name)
    parts: dict[tuple, list[str]] = {}
    for r in spark.read.schema("event_date date, load_id string, merged string").parquet(journal).collect():
        parts.setdefault((r["event_date"], r["merged"]), []).append(r["load_id"])
    for (day, merged), loads in parts.items():
        date = f"event_date={tables.NULL_PARTITION if day is None else day}"
        if tables.path_exists(spark, f"{rows}/{date}/load_id={merged}"):
            tables.remove(spark, f"{root}/{date}/load_id={merged}")
            tables.move(spark, f"{rows}/{date}/load_id={merged}", f"{root}/{date}/load_id={merged}")
        for load in loads:
            tables.remove(spark, f"{root}/{date}/load_id={tables.escaped(spark, load)}")
    tables.remove(spark, journal)
    tables.remove(spark, rows)
