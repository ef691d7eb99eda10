"""Stateful stream operators: duplicate suppression and daily totals."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakeops.functions.calendar import utc_date, utc_instant


def drop_duplicates(events: DataFrame, key: str, time_column: str, delay: str, salts: int = 16) -> DataFrame:
    """Keep one event per key among those whose times are within ``delay``.

    The first pass works on (key, salt), so the copies of a much repeated key are thinned out by ``salts`` tasks before the
    second pass brings what is left of a key together.  ``salts=1`` skips the first pass.
    """
    columns = events.columns
    timed = events.withColumn("_time", utc_instant(F.col(time_column))).withWatermark("_time", delay)
    if salts > 1:
        timed = timed.withColumn("_salt", F.pmod(F.spark_partition_id(), F.lit(salts)))
        timed = timed.dropDuplicatesWithinWatermark([key, "_salt"])
    return timed.dropDuplicatesWithinWatermark([key]).select(*columns)


def daily_totals(events: DataFrame, time_column: str, delay: str, totals: dict[str, Column]) -> DataFrame:
    """Totals per UTC day, each day given out once the watermark passes its end."""
    timed = events.withColumn("_time", utc_instant(F.col(time_column))).withWatermark("_time", delay)
    grouped = timed.groupBy(F.window("_time", "1 day").alias("day")).agg(*[c.alias(n) for n, c in totals.items()])
    return grouped.select(utc_date(F.col("day.start")).alias("event_date"), *totals)
