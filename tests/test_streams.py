"""Draining feeds and stateful stream operators."""

import json
import os
from datetime import datetime, timedelta, timezone

import pytest
from pyspark.sql import functions as F

from conftest import rows
from lakeops.contracts import FEEDS
from lakeops.sources import feeds, tables
from lakeops.streaming import drain, windows

FEED = FEEDS["errors"]


def _body(event_id, ts="2024-01-01T00:00:00", **changes):
    body = {"event_id": event_id, "event_ts": ts, "event_type": "order_error", "error_id": "x", "order_id": "o", "error_code": "c"}
    return json.dumps({**body, "detected_ts": ts, **changes})


def _land(folder, name, *bodies):
    os.makedirs(folder, exist_ok=True)
    with open(f"{folder}/{name}.json", "w") as out:
        out.write("\n".join(bodies) + "\n")


@pytest.fixture
def landing(tmp_path):
    for region in ("north", "south", "east", "west"):
        _land(f"{tmp_path}/errors_{region}", "a", _body(f"{region}-1"), _body(f"{region}-2", order_id=5), "not json")
    return str(tmp_path)


def _ids(spark, warehouse):
    return sorted(r.event_id for r in tables.scan(spark, warehouse, FEED.table).collect())


def test_drain_stores_each_event_once_and_keeps_bad_ones(spark, landing, warehouse):
    def source(queue):
        return feeds.stream_json_lines(spark, f"{landing}/{queue}")

    for _ in range(2):
        drain.drain(spark, FEED, source, warehouse, f"{landing}/checkpoints")
        assert _ids(spark, warehouse) == ["east-1", "north-1", "south-1", "west-1"]
        bad = drain.read_quarantine(spark, warehouse, FEED)
        assert bad.groupBy("reason").count().collect().__len__() == 2 and bad.count() == 8

    _land(f"{landing}/errors_north", "b", _body("north-3", "2024-01-02T00:00:00Z"))
    drain.drain(spark, FEED, source, warehouse, f"{landing}/checkpoints")
    assert _ids(spark, warehouse) == ["east-1", "north-1", "north-3", "south-1", "west-1"]


def test_a_repeated_batch_replaces_itself(spark, warehouse):
    bodies = spark.createDataFrame([(_body("a"),), (_body("b"),), ("bad",)], "body string")
    for _ in range(2):
        drain.write_events(bodies, FEED, warehouse, "errors_north-000000000000")
    assert _ids(spark, warehouse) == ["a", "b"]
    assert drain.read_quarantine(spark, warehouse, FEED).count() == 1


def test_quarantine_time_is_utc(spark, warehouse):
    spark.conf.set("spark.sql.session.timeZone", "Asia/Tokyo")
    try:
        drain.write_events(spark.createDataFrame([("bad",)], "body string"), FEED, warehouse, "one")
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    stored = drain.read_quarantine(spark, warehouse, FEED).first().ingest_ts
    assert abs(datetime.now(timezone.utc).replace(tzinfo=None) - stored) < timedelta(minutes=5)


def test_unique_skips_known_ids(spark, warehouse):
    first = spark.createDataFrame([(_body("a"),), (_body("a"),), (_body("b"),)], "body string")
    drain.write_events(first, FEED, warehouse, "one", unique=True)
    assert _ids(spark, warehouse) == ["a", "b"]
    second = spark.createDataFrame([(_body("a"),), (_body("c"),)], "body string")
    for _ in range(2):
        drain.write_events(second, FEED, warehouse, "two", unique=True)
    assert _ids(spark, warehouse) == ["a", "b", "c"]


START = datetime(2024, 1, 1)


def _run(spark, folder, build):
    """Feed two files as two micro-batches through a stream and return what came out."""
    schema = "event_id string, ts timestamp_ntz, n bigint"
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(f"{folder}/in")
    out = build(stream)
    query = (
        out.writeStream.format("parquet")
        .option("checkpointLocation", f"{folder}/cp")
        .trigger(availableNow=True)
        .start(f"{folder}/out")
    )
    query.awaitTermination()
    return spark.read.schema(out.schema).parquet(f"{folder}/out")


def _batch(spark, folder, name, items):
    frame = spark.createDataFrame([(i, START + timedelta(hours=h), n) for i, h, n in items], "event_id string, ts timestamp_ntz, n bigint")
    frame.coalesce(1).write.parquet(f"{folder}/stage-{name}")
    os.makedirs(f"{folder}/in", exist_ok=True)
    source = next(f for f in os.listdir(f"{folder}/stage-{name}") if f.endswith(".parquet"))
    os.link(f"{folder}/stage-{name}/{source}", f"{folder}/in/{name}.parquet")


@pytest.mark.parametrize("salts", [1, 4])
def test_stream_duplicates(spark, tmp_path, salts):
    folder = str(tmp_path)
    _batch(spark, folder, "a", [("x", 0, 1), ("x", 0, 1), ("y", 1, 1)])
    _batch(spark, folder, "b", [("x", 2, 1), ("z", 3, 1), ("y", 1, 1)])
    got = _run(spark, folder, lambda s: windows.drop_duplicates(s, "event_id", "ts", "1 day", salts=salts))
    assert rows(got, "event_id") == [("x",), ("y",), ("z",)]


@pytest.mark.parametrize("zone", ["UTC", "America/New_York"])
def test_stream_daily_totals(spark, tmp_path, zone):
    folder = str(tmp_path)
    spark.conf.set("spark.sql.session.timeZone", zone)
    _batch(spark, folder, "a", [("a", 1, 5), ("b", 20, 7), ("c", 26, 1)])
    _batch(spark, folder, "b", [("d", 2, 4), ("e", 60, 1)])
    try:
        got = _run(
            spark, folder, lambda s: windows.daily_totals(s, "ts", "12 hours", {"events": F.count("*"), "total": F.sum("n")})
        )
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    # the late "d" is within the 12 hours' grace of day one; day three is still open
    assert rows(got) == [(START.date(), 3, 16), ((START + timedelta(days=1)).date(), 1, 1)]
