"""Event bodies as DataFrames: JSON lines in a folder, or a Kafka topic."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeops.contracts import Feed
from lakeops.functions.calendar import iso_text


def read_json_lines(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.text(path).select(F.col("value").alias("body"))


def stream_json_lines(spark: SparkSession, path: str, max_bytes_per_batch: int = 64 << 30) -> DataFrame:
    """New files of the folder as a stream, at most ``max_bytes_per_batch`` per micro-batch."""
    return spark.readStream.option("maxBytesPerTrigger", max_bytes_per_batch).text(path).select(F.col("value").alias("body"))


def stream_kafka(spark: SparkSession, servers: str, topic: str, max_offsets_per_batch: int = 200_000_000, **options) -> DataFrame:
    """A topic as a stream; needs Spark's Kafka connector on the class path."""
    reader = (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", topic)
        .option("startingOffsets", "earliest")
        .option("maxOffsetsPerTrigger", max_offsets_per_batch)
    )
    return reader.options(**options).load().select(F.col("value").cast("string").alias("body"))


def to_bodies(events: DataFrame, feed: Feed, keep: tuple[str, ...] = ()) -> DataFrame:
    """Events as JSON bodies in the feed's payload form (what a producer publishes)."""
    form = {"TIMESTAMP": iso_text, "DATE": lambda c: c.cast("string")}
    values = [form.get(c.kind, lambda v: v)(F.col(c.name)).alias(c.source) for c in feed.columns]
    return events.select(*keep, F.to_json(F.struct(*values)).alias("body"))
