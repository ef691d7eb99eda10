"""Views over stored tables, so that dashboard SQL written against ``module.table`` names runs unchanged."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from lakeops.contracts import DIMS, FACTS
from lakeops.sources import tables


@dataclass(frozen=True)
class ViewResult:
    name: str
    created: bool
    reason: str | None = None


def register_view(spark: SparkSession, warehouse: str, table: str) -> ViewResult:
    """Create or replace ``module.table`` over the stored table; a missing table is skipped with a reason.

    The view reads an external catalog table ``module._files_of_<table>`` with the declared schema over the stored folder, so no file is opened to infer
    one: a column that some files lack, even the newest, is NULL there, and dates and loads still prune folders.  Dropping either leaves the files alone.
    """
    contract = tables.contract_of(table)
    path = tables.table_path(warehouse, contract.name)
    tables.ensure_namespace(spark, warehouse, contract.module)
    view_name, files_name = f"`{contract.module}`.`{contract.short_name}`", f"`{contract.module}`.`_files_of_{contract.short_name}`"
    if not tables.table_exists(spark, warehouse, contract):
        return ViewResult(contract.name, False, f"missing table {path}: PATH_NOT_FOUND")
    typed = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in contract.schema.fields)
    listed = ", ".join(f"`{c}`" for c in contract.column_names)
    location = path.replace("'", "\\'")
    spark.sql(f"DROP TABLE IF EXISTS {files_name}")
    spark.sql(f"CREATE TABLE {files_name} ({typed}, load_id string) USING parquet LOCATION '{location}'")
    spark.sql(f"CREATE OR REPLACE VIEW {view_name} AS SELECT {listed} FROM {files_name}")
    return ViewResult(contract.name, True)


def register_views(spark: SparkSession, warehouse: str, names=FACTS + DIMS) -> list[ViewResult]:
    return [register_view(spark, warehouse, n) for n in names]


def register_derived_view(spark: SparkSession, warehouse: str, name: str, query: str) -> None:
    """Create or replace the view ``module.name`` of a query, such as an aggregate over other views."""
    module, short = name.split(".", 1)
    tables.ensure_namespace(spark, warehouse, module)
    spark.sql(f"CREATE OR REPLACE VIEW `{module}`.`{short}` AS {query}")


def register_frame(df: DataFrame, name: str) -> None:
    """Make a frame readable by name in this session's SQL, such as an aggregate that several queries share."""
    df.createOrReplaceTempView(name)


def view_exists(spark: SparkSession, name: str) -> bool:
    return spark.catalog.tableExists(name)


def view(spark: SparkSession, name: str) -> DataFrame:
    return spark.table(name)
