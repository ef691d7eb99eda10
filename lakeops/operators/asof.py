"""As-of joins: values as they were known at a fact's date."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lakeops.operators.joins import BROADCAST_BYTES, fits_broadcast
from lakeops.session import computed_once


def last_of_day(history: DataFrame, key: str, day: str, values: list[str], order: list[str]) -> DataFrame:
    """One row per key and day: the values of the row that comes last by ``order`` (of its ties the largest)."""
    last = F.max(F.struct(*[F.col(c).alias(f"_o{k}") for k, c in enumerate(order)], *[F.col(v).alias(f"_v{k}") for k, v in enumerate(values)]))
    rows = history.groupBy(key, day).agg(last.alias("_last"))
    return rows.select(key, day, *[F.col(f"_last._v{k}").alias(v) for k, v in enumerate(values)])


def as_of(
    fact: DataFrame, history: DataFrame, key: str, day: str, values: list[str], strict: bool = True, limit_bytes: int = BROADCAST_BYTES
) -> DataFrame:
    """Every fact row with ``values`` and ``known_since`` of the newest history row of its key before its day (without ``strict``: up to it); NULL without one.

    ``history`` has one row per key and day and the columns key, day and values (see ``last_of_day``).  The facts are reduced to their distinct keys and days first, so the
    window over a key holds days and not events, however hot the key is.  What was known on each of those days is joined back on key and day: broadcast if
    measured to be small, else by a shuffle in which a hot key is spread over its days.  A NULL key or day knows nothing.
    """
    days = fact.where(F.col(key).isNotNull() & F.col(day).isNotNull()).groupBy(key, day).agg(F.lit(True).alias("_asked"))
    dated = history.where(F.col(key).isNotNull() & F.col(day).isNotNull())
    told = dated.select(key, day, F.struct(F.col(day).alias("known_since"), *values).alias("_told"))
    both = days.select(key, day, "_asked", F.lit(None).cast(told.schema["_told"].dataType).alias("_told"))
    both = both.unionByName(told.withColumn("_asked", F.lit(False)))
    merged = both.groupBy(key, day).agg(F.bool_or("_asked").alias("_asked"), F.max("_told").alias("_told"))
    before = Window.partitionBy(key).orderBy(day).rowsBetween(Window.unboundedPreceding, -1 if strict else 0)
    known = merged.withColumn("_known", F.last("_told", ignorenulls=True).over(before)).where("_asked AND _known IS NOT NULL")
    known = computed_once(known.select(key, day, "_known.*"))
    side = F.broadcast(known) if fits_broadcast(known, limit_bytes) else known
    return fact.join(side, [key, day], "left").select(*fact.columns, *values, "known_since")
