"""Late rows and corrections, quarantined bodies under a changed contract, merged loads, views of differing files."""

import glob
import json
import os
import random
from collections import Counter
from dataclasses import replace
from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from conftest import rows
from lakeops import contracts
from lakeops.contracts import FEEDS, TABLES, Table, columns
from lakeops.operators import incremental, views
from lakeops.sources import merging, tables
from lakeops.streaming import drain, late, requeue

# Late rows

START = datetime(2024, 1, 1)
TOTALS = {"events": "1L", "total": "n"}
SCHEMA = "ts timestamp_ntz, n bigint"


def _plain_totals(batches):
    out = {}
    for ts, n in (r for b in batches for r in b):
        events, total = out.get(ts and ts.date(), (0, 0))
        out[ts and ts.date()] = (events + 1, total + n)
    return sorted(((d, *v) for d, v in out.items()), key=repr)


def test_late_rows_become_corrections(spark, tmp_path):
    rng = random.Random(6)
    batches = [[(START + timedelta(hours=rng.randrange(24 * (3 + 2 * k))), rng.randrange(9)) for _ in range(40)] for k in range(4)] + [[(None, 5)], []]
    root, schema = str(tmp_path), spark.createDataFrame([], SCHEMA).schema
    newest, expected_late = None, []
    for number, batch in enumerate(batches):
        if newest is not None:
            mark = newest - timedelta(days=2)
            expected_late += [r for r in batch if r[0] is None or datetime.combine(r[0].date() + timedelta(days=1), datetime.min.time()) <= mark]
        for _ in range(2):  # a repeated batch replaces what it wrote
            late.write_batch(spark.createDataFrame(batch, SCHEMA), number, root, "ts", "2 days", TOTALS)
        newest = max([newest or START, *(t for t, _ in batch if t)])
    assert expected_late and rows(late.late_rows(spark, root, schema)) == sorted(expected_late, key=repr)
    assert rows(late.corrections(spark, root, schema, "ts", TOTALS)) == _plain_totals([expected_late])
    assert rows(late.corrected(spark, root, schema, "ts", TOTALS)) == _plain_totals(batches)
    closed = {d for d, *_ in rows(late.given_out(spark, root, schema, "2 days", TOTALS))}
    assert closed and max(closed) + timedelta(days=1) <= (newest - timedelta(days=2)).date()
    # an earlier batch run again later still sees the watermark it saw
    late.write_batch(spark.createDataFrame(batches[1], SCHEMA), 1, root, "ts", "2 days", TOTALS)
    assert rows(late.late_rows(spark, root, schema)) == sorted(expected_late, key=repr)


# Quarantine

FEED = FEEDS["errors"]
RELAXED = replace(FEED, columns=tuple(c for c in FEED.columns if c.name != "order_id"))


def _body(event_id, **changes):
    body = {"event_id": event_id, "event_ts": "2024-01-01T00:00:00", "event_type": "order_error", "error_id": "x", "order_id": "o"}
    body |= {"error_code": "c", "detected_ts": "2024-01-01T00:00:00"}
    return json.dumps({k: v for k, v in {**body, **changes}.items() if v is not None})


def _stored(spark, warehouse):
    return rows(tables.scan(spark, warehouse, FEED.table, keep_load_id=True), "event_id", "load_id")


def test_requeued_bodies_end_in_one_table(spark, warehouse):
    assert requeue.requeue(spark, warehouse, RELAXED, "r").count() == 0
    loads = {
        "one": [_body("a"), _body("b", order_id=None), _body("b", order_id=None), "junk"],
        "two/2": [_body("c", order_id=None), _body("a", order_id=None)],
    }
    for load, bodies in loads.items():
        drain.write_events(spark.createDataFrame([(b,) for b in bodies], "body string"), FEED, warehouse, load)
    report = requeue.requeue(spark, warehouse, RELAXED, "r")
    assert rows(report) == [("one", 2, 1), ("two/2", 2, 0)]
    expected = [("a", "one"), ("b", "requeued-r-one"), ("c", "requeued-r-two/2")]  # a is known, b came twice
    assert _stored(spark, warehouse) == expected
    left = drain.read_quarantine(spark, warehouse, FEED)
    assert rows(left, "body", "reason", "load_id") == [("junk", "not a JSON object", "one")]
    assert rows(requeue.requeue(spark, warehouse, RELAXED, "s")) == [("one", 0, 1)]
    assert _stored(spark, warehouse) == expected
    assert tables.scan(spark, warehouse, FEED.table).where("event_id = 'b'").first().order_id is None


def test_a_requeue_that_died_is_repeated(spark, warehouse, monkeypatch):
    drain.write_events(spark.createDataFrame([(_body("b", order_id=None),), ("junk",)], "body string"), FEED, warehouse, "one")

    def die(*args, **options):
        raise OSError("lost")

    monkeypatch.setattr(requeue.conform, "rejected_events", die)
    with pytest.raises(OSError):
        requeue.requeue(spark, warehouse, RELAXED, "r")
    monkeypatch.undo()
    assert drain.read_quarantine(spark, warehouse, FEED).count() == 2 and len(_stored(spark, warehouse)) == 1
    requeue.requeue(spark, warehouse, RELAXED, "r")
    assert drain.read_quarantine(spark, warehouse, FEED).count() == 1 and _stored(spark, warehouse) == [("b", "requeued-r-one")]


# Merging

SMALL = Table("logistics_core.small_rows", columns("k STRING, ts TIMESTAMP, event_date DATE"), mark="ts")


def _fill(spark, warehouse, loads=5):
    rng, data = random.Random(2), []
    for load in range(loads):
        part = [(f"k{rng.randrange(50)}", START + timedelta(hours=rng.randrange(72))) for _ in range(40)] + [("none", None)]
        part = [(k, t, t and t.date()) for k, t in part]
        tables.append(spark.createDataFrame(part, SMALL.schema), warehouse, SMALL, f"load/{load}")
        data += part
    return sorted(data, key=repr)


def _files(warehouse):
    return glob.glob(f"{tables.table_path(warehouse, SMALL.name)}/*/*/*.parquet")


def test_merging_keeps_rows_and_marks_and_bounds_files(spark, warehouse):
    data = _fill(spark, warehouse)
    mark, before = incremental.high_water_mark(spark, warehouse, SMALL), len(_files(warehouse))
    assert merging.merge_small_loads(spark, warehouse, SMALL) == 20  # five loads of three dates and of no date
    assert rows(tables.scan(spark, warehouse, SMALL)) == data and incremental.high_water_mark(spark, warehouse, SMALL) == mark
    assert len(_files(warehouse)) == 4 < before
    assert merging.merge_small_loads(spark, warehouse, SMALL) == 0
    tables.append(spark.createDataFrame([("late", START, START.date())], SMALL.schema), warehouse, SMALL, "more")
    assert merging.merge_small_loads(spark, warehouse, SMALL) == 2
    assert rows(tables.scan(spark, warehouse, SMALL)) == sorted([*data, ("late", START, START.date())], key=repr)
    assert merging.merge_small_loads(spark, warehouse, SMALL, small_bytes=1) == 0


def test_bins_follow_sizes(spark):
    sizes = [(date(2024, 1, 1), f"l{k}", 1, b) for k, b in enumerate([40, 40, 40, 500, 40, 10])] + [(date(2024, 1, 2), "alone", 1, 5)]
    got = merging.bins(spark.createDataFrame(sizes, "event_date date, load_id string, files int, bytes int"), 100, 100).collect()
    groups = {}
    for r in got:
        groups.setdefault(r.merged, set()).add(r.load_id)
    assert sorted(map(sorted, groups.values())) == [["l0", "l1", "l2"], ["l4", "l5"]]


@pytest.mark.parametrize("dies_at", [0, 1, 3, 7])
def test_a_merge_that_died_is_completed(spark, warehouse, monkeypatch, dies_at):
    data = _fill(spark, warehouse)
    calls = Counter()

    def counted(name):
        real = getattr(tables, name)

        def step(spark, path, *more):
            if "small_rows" in path and os.path.exists(merging._place(warehouse, SMALL, "journal")):
                calls["n"] += 1
                if calls["n"] > dies_at:
                    raise OSError("lost")
            return real(spark, path, *more)

        return step

    for name in ("remove", "move"):
        monkeypatch.setattr(tables, name, counted(name))
    with pytest.raises(OSError):
        merging.merge_small_loads(spark, warehouse, SMALL)
    monkeypatch.undo()
    merging.finish(spark, warehouse, SMALL)
    assert rows(tables.scan(spark, warehouse, SMALL)) == data and len(_files(warehouse)) == 4
    merging.finish(spark, warehouse, SMALL)
    assert merging.merge_small_loads(spark, warehouse, SMALL) == 0


# Views


def test_a_view_shows_declared_columns_of_differing_files(spark, warehouse):
    name = "order_errors.fact_order_errors"
    noon = datetime(2024, 3, 1, 12)
    event = ("e", noon, "order_error", "x", "o", "c", noon)
    tables.append(spark.createDataFrame([(*event, "seen", noon.date())], TABLES[name].schema), warehouse, name, "with")
    older = Table(name, tuple(c for c in TABLES[name].columns if c.name != "details"))
    later = noon + timedelta(days=1)
    tables.append(spark.createDataFrame([("f", *event[1:], later.date())], older.schema), warehouse, older, "without")
    assert views.register_view(spark, warehouse, name).created
    assert rows(spark.table(name), "event_id", "details") == [("e", "seen"), ("f", None)]
    assert spark.table(name).schema.simpleString() == contracts.TABLES[name].schema.simpleString()
    plan = spark.table(name).where("event_date > date'2024-03-01'")._jdf.queryExecution().executedPlan().toString()
    assert "event_date" in plan.split("PartitionFilters: [")[1].split("]")[0]
    spark.sql("DROP VIEW order_errors.fact_order_errors")
    spark.sql("DROP TABLE order_errors._files_of_fact_order_errors")
    assert tables.scan(spark, warehouse, name).where(F.col("details").isNull()).count() == 1
