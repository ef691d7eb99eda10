"""Stored tables: location, typed scan, existence, append.

A table is a Parquet folder ``<warehouse>/<module>/<name>`` partitioned by ``event_date`` and ``load_id``.  Every write owns its
``load_id``, so concurrent loads never touch each other's files and a repeated load replaces its own output (see ``append``).
"""

from __future__ import annotations

import uuid
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakeops.contracts import TABLES, Table

PARTITION_COLUMNS = ("event_date", "load_id")
NULL_PARTITION = "__HIVE_DEFAULT_PARTITION__"  # fixed value: the folder that Spark's writer gives NULL


def table_path(warehouse: str, table: str) -> str:
    module, name = table.split(".", 1)
    return f"{warehouse.rstrip('/')}/{module}/{name}"


def contract_of(table: str | Table) -> Table:
    return table if isinstance(table, Table) else TABLES[table]


def scan(spark: SparkSession, warehouse: str, table: str | Table, keep_load_id: bool = False) -> DataFrame:
    """The table with its declared columns; a column that older files lack reads as NULL.

    The schema is declared, so no file is opened to infer it.  Raises ``AnalysisException`` when the table does not exist.
    """
    contract = contract_of(table)
    df = spark.read.schema(_stored_schema(contract)).parquet(table_path(warehouse, contract.name))
    return df if keep_load_id else df.select(*contract.column_names)


def scan_date(spark: SparkSession, warehouse: str, table: str | Table, date: str) -> DataFrame:
    """The rows of one date with their ``load_id``; only that date's folder is listed."""
    contract = contract_of(table)
    root = table_path(warehouse, contract.name)
    return spark.read.schema(_stored_schema(contract)).option("basePath", root).parquet(f"{root}/event_date={date}")


def _stored_schema(contract: Table) -> T.StructType:
    return T.StructType(contract.schema.fields + [T.StructField("load_id", T.StringType())])


def folder(spark: SparkSession, path: str):
    """The file system that holds the path, and the path as that file system takes it."""
    root = spark._jvm.org.apache.hadoop.fs.Path(path)
    return root.getFileSystem(spark._jsc.hadoopConfiguration()), root


def partition_values(spark: SparkSession, path: str, column: str) -> list[str]:
    """The values of the folders ``column=value`` right below the path: one listing of one level."""
    files, root = folder(spark, path)
    names = [status.getPath().getName() for status in files.listStatus(root) if status.isDirectory()]
    return [unquote(name.removeprefix(f"{column}=")) for name in names if name.startswith(f"{column}=")]


def table_exists(spark: SparkSession, warehouse: str, table: str | Table) -> bool:
    """Whether the table's folder exists; lists no file and runs no job."""
    return path_exists(spark, table_path(warehouse, contract_of(table).name))


def path_exists(spark: SparkSession, path: str) -> bool:
    files, root = folder(spark, path)
    return files.exists(root)


def stored_dates(spark: SparkSession, warehouse: str, table: str | Table) -> list[str]:
    """The dates that have a folder, newest first.  What reaches the driver is one name per calendar day."""
    dates = partition_values(spark, table_path(warehouse, contract_of(table).name), "event_date")
    return sorted((d for d in dates if d != NULL_PARTITION), reverse=True)


def loads_of(spark: SparkSession, warehouse: str, table: str | Table, date: str) -> list[str]:
    """The loads that wrote rows of a date."""
    return partition_values(spark, f"{table_path(warehouse, contract_of(table).name)}/event_date={date}", "load_id")


def escaped(spark: SparkSession, value: str) -> str:
    """A partition value as Spark writes it in a folder's name."""
    return spark._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.escapePathName(value)


def move(spark: SparkSession, source: str, target: str) -> None:
    files, old = folder(spark, source)
    _, new = folder(spark, target)
    files.mkdirs(new.getParent())
    if not files.rename(old, new):
        raise OSError(f"cannot move {source} to {target}")


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder if it is there."""
    files, root = folder(spark, path)
    files.delete(root, True)


def load_versions(spark: SparkSession, warehouse: str, table: str | Table) -> dict[str, int]:
    """The loads that the table holds, each with a digest of its files' names: it changes when a load is replaced.  A row per load reaches the driver."""
    contract = contract_of(table)
    if not table_exists(spark, warehouse, contract):
        return {}
    rows = spark.read.schema(_stored_schema(contract)).parquet(table_path(warehouse, contract.name))
    files = rows.select("load_id", F.xxhash64("_metadata.file_path").alias("file")).distinct()
    return {r["load_id"]: r["version"] for r in files.groupBy("load_id").agg(F.bit_xor("file").alias("version")).collect()}


def conform_to(df: DataFrame, contract: Table, *more: str) -> DataFrame:
    """Declared columns in declared order and type, and ``more``; a declared column the input lacks is a typed NULL."""
    present = set(df.columns)
    return df.select(
        *[
            (F.col(f.name) if f.name in present else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in contract.schema.fields
        ],
        *more,
    )


def append(
    df: DataFrame,
    warehouse: str,
    table: str | Table,
    load_id: str | Column | None = None,
    by_date: bool = False,
    max_records_per_file: int = 20_000_000,
) -> str:
    """Append the declared columns of ``df`` and return the ``load_id`` written.  A column as ``load_id`` gives each row's load.

    * ``rebalance`` gives each date its own files of AQE's advisory size and splits a date that holds much of the load, where
      ``repartition("event_date")`` would send it whole to one task.  Pass ``by_date=True`` when the rows come straight from a
      table stored by date: each task then holds few dates already, and nothing is shuffled.
    * Rows are sorted by the mark column inside each file, so ``mark > x`` skips row groups.
    * Dynamic partition overwrite replaces only the (event_date, load_id) folders of this load: a retried load with the same
      ``load_id`` and the same rows replaces itself, and an empty one writes nothing.
    """
    contract = contract_of(table)
    load = uuid.uuid4().hex if load_id is None else load_id
    order = [c for c in (*PARTITION_COLUMNS, contract.mark) if c]
    rows = conform_to(df.withColumn("__load", load if isinstance(load, Column) else F.lit(load)), contract, "__load").withColumnRenamed("__load", "load_id")
    if not by_date:
        rows = rows.hint("rebalance", "event_date")
    (
        rows.sortWithinPartitions(*dict.fromkeys(order))
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .option("maxRecordsPerFile", max_records_per_file)
        .partitionBy(*PARTITION_COLUMNS)
        .parquet(table_path(warehouse, contract.name))
    )
    return load


def ensure_table(spark: SparkSession, warehouse: str, table: str | Table) -> bool:
    """Create the empty table unless it exists; True when it was created."""
    if table_exists(spark, warehouse, table):
        return False
    append(spark.createDataFrame([], contract_of(table).schema), warehouse, table)
    return True


def ensure_namespace(spark: SparkSession, warehouse: str, module: str) -> None:
    """The module as a database of the session catalog.

    Its folder is not the one that holds the module's tables: dropping a database deletes its folder.
    """
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{module}` LOCATION '{warehouse.rstrip('/')}/_views/{module}'")


def bootstrap_ml_tables(spark: SparkSession, warehouse: str) -> list[str]:
    """The empty prediction tables, so that readers work before the first prediction is written."""
    names = ["ml_insights.raw_stockout_risk", "ml_insights.raw_demand_forecast"]
    return [n for n in names if ensure_table(spark, warehouse, n)]
