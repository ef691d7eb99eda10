"""Table checks: does each table exist and hold rows."""

from __future__ import annotations

from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeops.contracts import CHECKED_TABLES
from lakeops.operators import views
from lakeops.sources import tables


def row_count(df: DataFrame, alias: str = "cnt") -> DataFrame:
    return df.agg(F.count("*").alias(alias))


def has_rows(df: DataFrame) -> bool:
    """Stops at the first row found."""
    return not df.isEmpty()


def report(spark: SparkSession, frames: dict[str, DataFrame | None]) -> DataFrame:
    """One row per table: name, exists, rows, status (ok / bad / skipped) and message. All tables count in one job."""
    parts = []
    for name, df in frames.items():
        if df is None:
            counted = spark.range(1).select(F.lit(None).cast("bigint").alias("n"))
        else:
            counted = df.agg(F.count("*").alias("n"))
        parts.append(counted.select(F.lit(name).alias("table_name"), F.lit(df is not None).alias("table_exists"), F.col("n")))
    rows = reduce(DataFrame.unionByName, parts)
    status = F.when(~F.col("table_exists"), "skipped").when(F.col("n") > 0, "ok").otherwise("bad")
    message = F.when(~F.col("table_exists"), "table not found").otherwise(F.concat(F.lit("count="), F.col("n").cast("string")))
    return rows.select("table_name", "table_exists", F.col("n").alias("row_count"), status.alias("status"), message.alias("message"))


def check_tables(spark: SparkSession, warehouse: str, names=CHECKED_TABLES) -> DataFrame:
    """The report over stored tables."""
    found = {n: tables.scan(spark, warehouse, n) if tables.table_exists(spark, warehouse, n) else None for n in names}
    return report(spark, found)


def check_views(spark: SparkSession, names=CHECKED_TABLES) -> DataFrame:
    """The report over registered views; a view whose table is gone counts as missing."""
    found: dict[str, DataFrame | None] = {}
    for name in names:
        try:
            found[name] = views.view(spark, name) if views.view_exists(spark, name) else None
        except AnalysisException:
            found[name] = None
    return report(spark, found)
