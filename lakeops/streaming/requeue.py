"""Quarantined bodies validated again, under a contract that has changed."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeops.contracts import TABLES, Feed
from lakeops.operators import conform, dedupe
from lakeops.session import computed_once
from lakeops.sources import tables
from lakeops.streaming import drain

PREFIX = "requeued"


def requeue(spark: SparkSession, warehouse: str, feed: Feed, run: str) -> DataFrame:
    """Move the quarantined bodies that ``feed`` now accepts to its raw table; the others stay, with their new reason.

    ``feed`` is the changed contract (of the same table; columns that it no longer asks for are NULL).  Moved events get the load ``requeued-<run>-<load>`` where the
    load is the one that rejected them, so the raw table says where they come from.  Each is added once: ids that the table holds already, of whatever load but this
    run's, are not added again.

    The verdicts are written to the checkpoint folder first.  Then the events are appended, replacing what an earlier attempt of the run wrote; last the
    quarantine's folders are replaced by what is left in them.  A run that died is repeated under its name; a second run finds nothing more to move.
    Returns one row per load: load_id, moved (bodies accepted) and left.
    """
    path = drain.quarantine_path(warehouse, feed)
    if not tables.path_exists(spark, path):
        return spark.createDataFrame([], "load_id string, moved long, left long")
    kept = ("ingest_ts", "load_id")
    decoded = computed_once(conform.decode(drain.read_quarantine(spark, warehouse, feed), feed, keep=kept))
    valid = conform.valid_events(decoded, feed, keep=("load_id",)).withColumn("load_id", F.concat_ws("-", F.lit(PREFIX), F.lit(run), "load_id"))
    if tables.table_exists(spark, warehouse, feed.table):
        stored = tables.scan(spark, warehouse, TABLES[feed.table], keep_load_id=True).where(~F.col("load_id").startswith(f"{PREFIX}-{run}-"))
        new = dedupe.new_once(valid, stored.select("event_id"), "event_id")
    else:
        new = dedupe.one_row_per(valid, "event_id")
    tables.append(new, warehouse, feed.table, load_id=F.col("load_id"))
    left = conform.rejected_events(decoded, feed, keep=kept).select("body", "reason", *kept)
    left.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("load_id").parquet(path)
    report = computed_once(decoded.groupBy("load_id").agg(F.count_if(F.col("reason").isNull()).alias("moved"), F.count_if(F.col("reason").isNotNull()).alias("left")))
    for row in report.where("left = 0").select("load_id").collect():  # a row per load
        tables.remove(spark, f"{path}/load_id={tables.escaped(spark, row['load_id'])}")
    return report
