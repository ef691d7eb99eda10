"""Calendar parts and UTC times, as plain column expressions that do not depend on the session time zone."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def week_of_year(day: Column) -> Column:
    """Monday-first week number 0..53: days before the year's first Monday are in week 0 (not the ISO week)."""
    return F.floor((F.dayofyear(day) + 6 - F.weekday(day)) / 7).cast("int")


def calendar_parts(day: Column) -> list[Column]:
    return [
        F.dayofmonth(day).alias("day"),
        week_of_year(day).alias("week"),
        F.month(day).alias("month"),
        F.quarter(day).alias("quarter"),
        F.year(day).alias("year"),
    ]


def utc_now() -> Column:
    """The current UTC time, without zone."""
    return F.convert_timezone(None, F.lit("UTC"), F.localtimestamp())


def iso_text(time: Column) -> Column:
    """A zoneless time as ISO text."""
    return F.replace(time.cast("string"), F.lit(" "), F.lit("T"))


def utc_instant(time: Column) -> Column:
    """The instant at which UTC clocks show a zoneless time (streams need an instant for their watermark)."""
    since_epoch = time - F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
    return F.timestamp_seconds(F.lit(0)) + since_epoch


def utc_date(instant: Column) -> Column:
    """The UTC date of an instant."""
    days = F.floor(F.unix_seconds(instant) / 86400).cast("int")
    return F.date_add(F.lit("1970-01-01").cast("date"), days)
