"""CSV replay: turn static CSV files into event bodies for the same ingest as live events."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeops.contracts import Column as Field
from lakeops.contracts import Feed
from lakeops.functions.calendar import iso_text, utc_now


def _number(text: Column, kind: str) -> Column:
    """Integers and floats as JSON numbers; text that is neither stays as it is and is rejected by the ingest."""
    number = F.trim(text).try_cast("bigint" if kind in ("INT", "LONG") else "double")
    return F.when(number.isNotNull(), number.cast("variant")).otherwise(text.cast("variant"))


def _value(field: Field, present: set[str], feed: Feed, now: Column, short: Column) -> Column:
    if field.name == "event_type":
        return F.lit(feed.event_type)
    fill = {"uuid": F.uuid(), "now": iso_text(now), None: F.lit(None)}[field.default]
    if field.source not in present or field.name in ("event_id", "event_ts"):
        return fill
    text = F.col(f"`{field.source}`")
    if field.kind in ("INT", "LONG", "DOUBLE"):
        return _number(text, field.kind)
    return F.when(text.isNull() & ~short, "").otherwise(text)  # an empty CSV field is empty text, a missing one is missing


def replay_csv(spark: SparkSession, path: str, feed: Feed, run_ts: str | None = None, multi_line: bool = False) -> DataFrame:
    """One JSON ``body`` per CSV row.

    Columns are taken by header name and further columns are ignored.  Every event gets a new id and the replay time; ids and
    times the feed lets the CSV omit are filled the same way.  A row with a missing or malformed required value gives a body
    the ingest rejects, so it lands in the quarantine instead of ending the replay.  ``multi_line`` reads quoted line breaks,
    at the price of one task per file.
    """
    reader = spark.read.option("header", True).option("escape", '"').option("multiLine", multi_line)
    names = reader.csv(path).columns
    listed = ", ".join(f"`{n}` string" for n in names)
    rows = (
        reader.schema(f"{listed}, _malformed string")
        .option("columnNameOfCorruptRecord", "_malformed")
        .option("enforceSchema", False)  # files whose headers differ are an error, not a mix-up
        .option("columnPruning", False)  # a row is known to be short only if all its columns are looked at
        .csv(path)
    )
    short = F.col("_malformed").isNotNull() & F.col(f"`{names[-1]}`").isNull()
    now = F.lit(run_ts).cast("timestamp_ntz") if run_ts else utc_now()
    values = [_value(c, set(names), feed, now, short).alias(c.source) for c in feed.columns]
    return rows.select(F.to_json(F.struct(*values)).alias("body"))
