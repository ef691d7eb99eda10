"""Drain event feeds into raw tables: everything pending is validated and appended, then the stream stops."""

from __future__ import annotations

from collections.abc import Callable

from pyspark import StorageLevel
from pyspark.errors import StreamingQueryException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from lakeops.contracts import TABLES, Feed
from lakeops.functions.calendar import utc_now
from lakeops.operators import conform, dedupe, joins
from lakeops.sources import tables


def quarantine_path(warehouse: str, feed: Feed) -> str:
    return tables.table_path(warehouse, feed.table) + "__quarantine"


def write_events(
    bodies: DataFrame, feed: Feed, warehouse: str, load_id: str, ingest_ts: str | None = None, unique: bool = False
) -> None:
    """Append the valid events of one batch to the raw table and the others to its quarantine.

    Both writes replace what an earlier attempt of the same ``load_id`` wrote, so a batch that is run again after a failure
    leaves one copy.  With ``unique``, events whose id the batch repeats or the table already holds are skipped.  Copies of an
    event share its date, so only the stored dates that the batch has are looked at; what the same ``load_id`` wrote does not
    count as held.
    """
    decoded = conform.decode(bodies, feed)
    rejected_body = F.when(F.col("reason").isNotNull(), F.col("body"))  # the cache need not hold the text of valid events
    decoded = decoded.withColumn("body", rejected_body).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        valid = conform.valid_events(decoded, feed)
        if unique:
            days = valid.select("event_date").distinct()
            valid = _once_and_not_yet_loaded(valid, days, feed, warehouse, load_id)
        tables.append(valid, warehouse, feed.table, load_id)
        now = F.lit(ingest_ts).cast("timestamp_ntz") if ingest_ts else utc_now()
        (
            conform.rejected_events(decoded, feed)
            .select("body", "reason", now.alias("ingest_ts"), F.lit(load_id).alias("load_id"))
            .write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy("load_id")
            .parquet(quarantine_path(warehouse, feed))
        )
    finally:
        decoded.unpersist()


def _once_and_not_yet_loaded(valid: DataFrame, days: DataFrame, feed: Feed, warehouse: str, load_id: str) -> DataFrame:
    spark = valid.sparkSession
    if not tables.table_exists(spark, warehouse, feed.table):
        return dedupe.one_row_per(valid, "event_id")
    stored = tables.scan(spark, warehouse, TABLES[feed.table], keep_load_id=True).where(F.col("load_id") != load_id)
    days = F.broadcast(days) if joins.fits_broadcast(days) else days
    return dedupe.new_once(valid, stored.join(days, "event_date", "left_semi"), "event_id")


def read_quarantine(spark: SparkSession, warehouse: str, feed: Feed) -> DataFrame:
    schema = "body string, reason string, ingest_ts timestamp_ntz, load_id string"
    return spark.read.schema(schema).parquet(quarantine_path(warehouse, feed))


def start_drain(
    bodies: DataFrame,
    feed: Feed,
    queue: str,
    warehouse: str,
    checkpoint: str,
    every: str | None = None,
    unique: bool = False,
) -> StreamingQuery:
    """Start one queue's stream into the feed's raw table.

    By default it processes what is pending and stops; ``every="1 hour"`` keeps it running instead.  The checkpoint records
    which input a batch holds and the batch names its ``load_id``, so each event is stored once even if the job is restarted.
    """

    def write_batch(batch: DataFrame, batch_id: int) -> None:
        write_events(batch, feed, warehouse, f"{queue}-{batch_id:012d}", unique=unique)

    writer = bodies.writeStream.foreachBatch(write_batch).option("checkpointLocation", checkpoint).queryName(f"drain_{queue}")
    return (writer.trigger(processingTime=every) if every else writer.trigger(availableNow=True)).start()


def drain(
    spark: SparkSession,
    feed: Feed,
    source: Callable[[str], DataFrame],
    warehouse: str,
    checkpoint_root: str,
    unique: bool = False,
) -> None:
    """Drain all queues of a feed into its one raw table, side by side; ``source(queue)`` gives a queue's stream.

    With ``unique`` the queues run one after the other, so that each sees the ids the others stored.  If a queue fails, the
    queues beside it are drained to their end before the first failure is raised.
    """
    tables.ensure_table(spark, warehouse, feed.table)
    running = []
    for queue in feed.queues:
        query = start_drain(source(queue), feed, queue, warehouse, f"{checkpoint_root}/{queue}", unique=unique)
        running.append(query)
        if unique:
            query.awaitTermination()
    failures = []
    for query in running:
        try:
            query.awaitTermination()
        except StreamingQueryException as failure:
            failures.append(failure)
    if failures:
        raise failures[0]
