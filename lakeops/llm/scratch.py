"""Intermediate tables in the folder that the cluster shares."""

from __future__ import annotations

import gc

from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession

from lakeops.session import shared_dir


def new_folder(spark: SparkSession) -> str:
    """A new folder under ``spark.checkpoint.dir``, deleted when the session's JVM ends."""
    path = spark._jvm.org.apache.hadoop.fs.Path(shared_dir(spark))
    fs = path.getFileSystem(spark._jsc.hadoopConfiguration())
    fs.mkdirs(path)
    fs.deleteOnExit(path)
    return path.toString()


def opened(path: str) -> tuple[fs.FileSystem, str]:
    """The file system that holds a path, and the path as that file system takes it."""
    return fs.FileSystem.from_uri(path if "://" in path else "file://" + path.removeprefix("file:"))


BATCH = "spark.sql.execution.arrow.maxRecordsPerBatch"


def stored(df: DataFrame, rows_per_batch: int | None = None) -> DataFrame:
    """``df`` written as Parquet in the shared folder and read again: computed once, and lost executors cost no recomputation.

    ``rows_per_batch`` bounds the Arrow batches of this one job, for operators that hold several copies of a batch.
    """
    return _stored_in(f"{new_folder(df.sparkSession)}/table", df, rows_per_batch)


def _stored_in(folder: str, df: DataFrame, rows_per_batch: int | None) -> DataFrame:
    conf = df.sparkSession.conf
    before = conf.get(BATCH, None)
    if rows_per_batch:
        conf.set(BATCH, str(rows_per_batch))
    try:
        df.write.parquet(folder)
    finally:
        if rows_per_batch:
            conf.unset(BATCH) if before is None else conf.set(BATCH, before)
    return df.sparkSession.read.schema(df.schema).parquet(folder)


class Shelf:
    """Intermediate tables by name, deleted as soon as they are used up."""

    def __init__(self, spark: SparkSession):
        self.spark, self.folders = spark, {}

    def put(self, name: str, df: DataFrame, rows_per_batch: int | None = None) -> DataFrame:
        self.folders[name] = new_folder(self.spark)
        return _stored_in(f"{self.folders[name]}/table", df, rows_per_batch)

    def drop(self, *names: str) -> None:
        """Delete tables that nothing reads any more, and let Spark clear the shuffles that wrote them."""
        for name in names:
            path = self.spark._jvm.org.apache.hadoop.fs.Path(self.folders.pop(name))
            path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)
        gc.collect()
        self.spark._jvm.System.gc()
