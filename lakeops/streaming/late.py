"""Daily totals of a stream that lose no late row.

A day is closed once the watermark, the newest event time of earlier batches less the delay, has passed its end; what is given out for it then is final.  Each batch is split
by the watermark that stood before it: rows of open days are added to the day's totals, rows of closed days go whole to the ``late`` table.  ``corrections`` sums
those by day, so that what was given out plus the corrections is what a batch query over all rows finds.

Everything a batch writes, its share of the totals, its late rows and the newest time so far, stands in folders named after the batch: a batch that is run
again after a failure sees the same watermark and replaces what it wrote.  Shares are one row per day and batch; no state is kept on executors.
"""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from lakeops.sources import tables


def _newest(spark: SparkSession, root: str, before: int | None = None) -> DataFrame:
    """The newest event time of all batches, or of those before one, as one row."""
    path = f"{root}/progress"
    schema = "newest timestamp_ntz, batch long"
    rows = spark.read.schema(schema).parquet(path) if tables.path_exists(spark, path) else spark.createDataFrame([], schema)
    return (rows if before is None else rows.where(F.col("batch") < before)).agg(F.max("newest").alias("newest"))


def _closed(day: Column, newest: Column, delay: str) -> Column:
    """Whether the watermark has passed the day's end; not while nothing was seen."""
    return F.coalesce(F.date_add(day, 1).cast("timestamp_ntz") <= newest - F.expr(f"interval {delay}"), F.lit(False))


def write_batch(batch: DataFrame, number: int, root: str, time_column: str, delay: str, totals: dict[str, str]) -> None:
    """Route one batch.  ``totals`` are SQL expressions to sum per day; rows without a time cannot be given out with a day and go to the late table."""
    spark = batch.sparkSession
    newest = _newest(spark, root, number).first()["newest"]  # one row
    day = F.col(time_column).cast("date")
    late = day.isNull() | _closed(day, F.lit(newest).cast("timestamp_ntz"), delay)
    marked = batch.withColumn("__day", day).withColumn("__late", late).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        shares = marked.where("NOT __late").groupBy(F.col("__day").alias("event_date")).agg(*[F.sum(F.expr(c)).alias(n) for n, c in totals.items()])
        shares.write.mode("overwrite").parquet(f"{root}/open/batch={number}")
        marked.where("__late").drop("__day", "__late").write.mode("overwrite").parquet(f"{root}/late/batch={number}")
        marked.agg(F.max(F.col(time_column)).cast("timestamp_ntz").alias("newest")).write.mode("overwrite").parquet(f"{root}/progress/batch={number}")
    finally:
        marked.unpersist()


def start_daily_totals(
    events: DataFrame, root: str, checkpoint: str, time_column: str, delay: str, totals: dict[str, str], every: str | None = None
) -> StreamingQuery:
    """Start the stream; by default it processes what is pending and stops."""
    writer = events.writeStream.foreachBatch(lambda batch, number: write_batch(batch, number, root, time_column, delay, totals))
    writer = writer.option("checkpointLocation", checkpoint)
    return (writer.trigger(processingTime=every) if every else writer.trigger(availableNow=True)).start()


def _schema(events: T.StructType, totals: dict[str, str], spark: SparkSession) -> T.StructType:
    summed = spark.createDataFrame([], events).agg(*[F.sum(F.expr(c)).alias(n) for n, c in totals.items()]).schema
    return T.StructType([T.StructField("event_date", T.DateType()), *summed.fields])


def shares(spark: SparkSession, root: str, events: T.StructType, totals: dict[str, str]) -> DataFrame:
    """The sums of rows that came in time, by day."""
    rows = spark.read.schema(_schema(events, totals, spark)).parquet(f"{root}/open")
    return rows.groupBy("event_date").agg(*[F.sum(n).alias(n) for n in totals])


def given_out(spark: SparkSession, root: str, events: T.StructType, delay: str, totals: dict[str, str]) -> DataFrame:
    """The totals of closed days, without late rows."""
    newest = F.lit(_newest(spark, root).first()["newest"]).cast("timestamp_ntz")  # one row
    return shares(spark, root, events, totals).where(_closed(F.col("event_date"), newest, delay))


def late_rows(spark: SparkSession, root: str, events: T.StructType) -> DataFrame:
    """The rows of the late table, whole."""
    return spark.read.schema(events).parquet(f"{root}/late").select(*events.names)


def corrections(spark: SparkSession, root: str, events: T.StructType, time_column: str, totals: dict[str, str]) -> DataFrame:
    """What late rows add to each day."""
    day = F.col(time_column).cast("date").alias("event_date")
    return late_rows(spark, root, events).groupBy(day).agg(*[F.sum(F.expr(c)).alias(n) for n, c in totals.items()])


def corrected(spark: SparkSession, root: str, events: T.StructType, time_column: str, totals: dict[str, str]) -> DataFrame:
    """The totals of all days so far, open ones too, with their corrections: what a batch query over all rows finds."""
    both = shares(spark, root, events, totals).unionByName(corrections(spark, root, events, time_column, totals))
    return both.groupBy("event_date").agg(*[F.sum(n).alias(n) for n in totals])
