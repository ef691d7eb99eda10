"""The lax validation rules, form by form."""

import json
from datetime import date, datetime

import pytest

from conftest import rows
from lakeops.contracts import FEEDS, Column, Feed
from lakeops.operators import conform
from lakeops.sources import feeds, replay

REJECTED = object()

FORMS = {
    "LONG": [
        (5, 5), (5.0, 5), (5.5, REJECTED), ("5", 5), ("5.0", 5), ("5.", REJECTED), ("5.5", REJECTED), (" 5 ", 5), ("+5", 5),
        ("-5", -5), ("--5", REJECTED), ("1_000", 1000), ("1__0", REJECTED), ("05", 5), ("", REJECTED), (True, 1), (False, 0),
        (None, REJECTED), ("1e3", REJECTED), (1e3, 1000), (1e7, 10**7), (1e20, REJECTED), (2**63 - 1, 2**63 - 1),
        (2**63, REJECTED), ([1], REJECTED), ({}, REJECTED), ("abc", REJECTED), ("1_0.0", 10), ("- 5", REJECTED), (-5.0, -5),
    ],
    "DOUBLE": [
        (5, 5.0), (5.5, 5.5), ("5.5", 5.5), (" 5.5 ", 5.5), ("1e3", 1000.0), ("", REJECTED), (True, 1.0), (None, REJECTED),
        ("abc", REJECTED), (".5", 0.5), ("5.", 5.0), ("0x10", REJECTED), ("5d", REJECTED), ("inf", float("inf")),
    ],
    "STRING": [("", ""), ("x", "x"), (5, REJECTED), (True, REJECTED), (None, REJECTED), ([1], REJECTED), ("ü", "ü")],
    "TIMESTAMP": [
        ("2024-01-01", datetime(2024, 1, 1)),
        ("2024-01-01T01:02:03", datetime(2024, 1, 1, 1, 2, 3)),
        ("2024-01-01 01:02:03", datetime(2024, 1, 1, 1, 2, 3)),
        ("2024-01-01T01:02", datetime(2024, 1, 1, 1, 2)),
        ("2024-01-01_01:02:03", datetime(2024, 1, 1, 1, 2, 3)),
        ("2024-01-01T01:02:03,5", datetime(2024, 1, 1, 1, 2, 3, 500000)),
        ("2024-01-01T01:02:03.123456789", datetime(2024, 1, 1, 1, 2, 3, 123456)),
        ("2024-01-01T01:02:03Z", datetime(2024, 1, 1, 1, 2, 3)),
        ("2024-01-01T01:02:03+05:30", datetime(2023, 12, 31, 19, 32, 3)),
        ("2024-01-01T01:02:03-0530", datetime(2024, 1, 1, 6, 32, 3)),
        ("2024-01-01T01:02:03+05", REJECTED),
        ("2024-01-01T01:02:03+24:00", REJECTED),
        ("2024-13-01", REJECTED),
        ("2023-02-29", REJECTED),
        ("2024-01-01T24:00:00", REJECTED),
        ("2024-01-01T23:59:60", REJECTED),
        ("2024", datetime(1970, 1, 1, 0, 33, 44)),
        ("12:30", REJECTED),
        ("1700000000", datetime(2023, 11, 14, 22, 13, 20)),
        (1700000000, datetime(2023, 11, 14, 22, 13, 20)),
        (1700000000.25, datetime(2023, 11, 14, 22, 13, 20, 250000)),
        (1700000000000, datetime(2023, 11, 14, 22, 13, 20)),
        (-1, datetime(1969, 12, 31, 23, 59, 59)),
        (True, REJECTED),
        (" 2024-01-01", REJECTED),
        ("2024-1-1", REJECTED),
        ("0000-01-01", REJECTED),
        ("", REJECTED),
        (1e30, REJECTED),
    ],
    "DATE": [
        ("2024-01-01", date(2024, 1, 1)),
        ("2024-01-01T00:00:00", date(2024, 1, 1)),
        ("2024-01-01T01:00:00", REJECTED),
        ("2024-01-01T00:00:00+05:00", date(2024, 1, 1)),
        (1700006400, date(2023, 11, 15)),
        (1700000000, REJECTED),
        ("2024-02-30", REJECTED),
        (None, REJECTED),
    ],
}


def _feed(kind):
    return Feed("t", "t", "m.t", (Column("event_ts", "TIMESTAMP"), Column("v", kind)), "event_ts")


@pytest.mark.parametrize("kind", FORMS)
@pytest.mark.parametrize("zone", ["UTC", "America/New_York"])
def test_forms(spark, kind, zone):
    """The outcome does not depend on the session time zone."""
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        feed = _feed(kind)
        bodies = [(i, json.dumps({"event_ts": "2024-01-01", "v": v, "extra": 1})) for i, (v, _) in enumerate(FORMS[kind])]
        decoded = conform.decode(spark.createDataFrame(bodies, "n int, body string"), feed, keep=("n",))
        got = {r.n: r for r in decoded.select("n", "v", "reason").collect()}
        for i, (value, expected) in enumerate(FORMS[kind]):
            if expected is REJECTED:
                assert got[i].v is None and got[i].reason == "missing or invalid: v", value
            else:
                assert got[i].v == expected and got[i].reason is None, value
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


GOOD = '{"event_ts":"2024-01-01","v":1}'


@pytest.mark.parametrize(
    "body, reason",
    [
        (GOOD, None),
        (f"  {GOOD}  ", None),
        ('{"event_ts":"2024-01-01","v":1,"v":2}', None),
        ("nope", "not a JSON object"),
        ("[1,2]", "not a JSON object"),
        (f"[{GOOD}]", "not a JSON object"),
        ("5", "not a JSON object"),
        ("null", "not a JSON object"),
        ("", "not a JSON object"),
        (None, "not a JSON object"),
        (f"{GOOD} tail", "not a JSON object"),
        (f"{GOOD},{GOOD}", "not a JSON object"),
        (f"{GOOD}]", "not a JSON object"),
        ("{'event_ts':'2024-01-01','v':1}", "not a JSON object"),
        ("{}", "missing or invalid: event_ts,v"),
        ('{"v":1}', "missing or invalid: event_ts"),
    ],
)
def test_documents(spark, body, reason):
    feed = _feed("LONG")
    bodies = spark.createDataFrame([(body,)], "body string")
    decoded = conform.decode(bodies, feed)
    assert decoded.first().reason == reason
    assert conform.valid_events(decoded, feed).count() == (reason is None)
    assert conform.rejected_events(decoded, feed).count() == (reason is not None)


def test_each_body_is_parsed_once(spark):
    feed = FEEDS["orders"]
    decoded = conform.decode(spark.createDataFrame([(GOOD,)], "body string"), feed)
    plan = conform.valid_events(decoded, feed)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("from_json(") == 1


def test_alias_must_be_the_json_name(spark):
    feed = FEEDS["errors"]
    common = {"event_id": "e", "event_ts": "2024-01-01", "event_type": "t", "error_id": "x", "order_id": "o", "error_code": "c"}
    bodies = [(json.dumps({**common, "detected_ts": "2024-05-06T07:08:09"}),), (json.dumps({**common, "error_ts": "2024-05-06"}),)]
    decoded = conform.decode(spark.createDataFrame(bodies, "body string"), feed)
    assert rows(conform.valid_events(decoded, feed), "error_ts", "event_date") == [
        (datetime(2024, 5, 6, 7, 8, 9), date(2024, 5, 6))
    ]
    assert conform.rejected_events(decoded, feed).first().reason == "missing or invalid: detected_ts"


def test_replay_fills_ids_and_times_and_keeps_bad_rows_apart(spark, tmp_path):
    path = tmp_path / "dispatch.csv"
    path.write_text(
        "eta,vehicle_id,ignored,status\n"
        "2024-01-02T03:04:05,V-N1,x,ASSIGNED\n"
        '2024-01-02T03:04:05,,x,"so ""called"", FAILED"\n'  # empty text is a text
        "2024-01-02T03:04:05,V-N2,x\n"  # a short row
        "soon,V-N3,x,FAILED\n"
        "2024-01-02T03:04:05,V-N4,x,FAILED,more\n"  # a long row
    )
    feed = FEEDS["dispatch_logs"]
    decoded = conform.decode(replay.replay_csv(spark, str(path), feed, "2025-01-01 00:00:00"), feed).cache()
    valid = conform.valid_events(decoded, feed).collect()
    assert sorted((r.vehicle_id, r.status) for r in valid) == [
        ("", 'so "called", FAILED'),
        ("V-N1", "ASSIGNED"),
        ("V-N4", "FAILED"),
    ]
    assert {(r.event_type, r.event_ts) for r in valid} == {("dispatch_log", datetime(2025, 1, 1))}
    assert len({i for r in valid for i in (r.event_id, r.dispatch_id, r.order_id)}) == 9
    assert rows(conform.rejected_events(decoded, feed), "reason") == [
        ("missing or invalid: eta",),
        ("missing or invalid: status",),
    ]


def test_replay_numbers_are_strict(spark, tmp_path):
    path = tmp_path / "sla.csv"
    path.write_text("order_id,vehicle_id,sla_minutes,actual_minutes\no1,v1,30,45\no2,v1,30.5,45\no3,v1,x,45\n")
    feed = FEEDS["delivery_sla"]
    decoded = conform.decode(replay.replay_csv(spark, str(path), feed), feed)
    assert rows(conform.valid_events(decoded, feed), "order_id", "sla_minutes", "actual_minutes") == [("o1", 30, 45)]


def test_bodies_round_trip(spark):
    feed = FEEDS["vehicle_tracking"]
    row = ("e", datetime(2024, 1, 1, 2, 3, 4, 567890), "vehicle_tracking", "VEH-001", 12.25, -0.1, 77)
    frame = spark.createDataFrame(
        [row],
        "event_id string, event_ts timestamp_ntz, event_type string, vehicle_id string, latitude double, longitude double, speed_kph bigint",
    )
    valid = conform.valid_events(conform.decode(feeds.to_bodies(frame, feed), feed), feed)
    assert tuple(valid.first()) == row + (date(2024, 1, 1),)


def test_a_body_cannot_close_the_array_around_it(spark):
    """Text after the object is found even if it looks like the end of the wrapper; brackets inside an object are fine."""
    feed = FEEDS["orders"]
    good = {"event_id": "e", "event_ts": "2024-01-01T00:00:00", "event_type": "t", "order_id": "[o]", "product_id": "p]", "warehouse_id": "w", "order_ts": "2024-01-01T00:00:00", "qty": 1}
    body = json.dumps(good)
    bodies = spark.createDataFrame([(body,), (body + ",{}] garbage",), (body + "] x",), (f"[{body}]",)], "body string")
    reasons = {r["body"]: r["reason"] for r in conform.decode(bodies, feed).select("body", "reason").collect()}
    assert [reasons[b] is None for b in (body, body + ",{}] garbage", body + "] x", f"[{body}]")] == [True, False, False, False]


def test_replay_keeps_what_it_cannot_read(spark, tmp_path):
    (tmp_path / "o.csv").write_text("product_id,warehouse_id,order_ts,qty\nP,W,2024-01-01T00:00:00,abc\nP,W,2024-01-01T00:00:00, 7\n")
    bodies = sorted((json.loads(r["body"])["qty"] for r in replay.replay_csv(spark, str(tmp_path), FEEDS["orders"]).collect()), key=str)
    assert bodies == [7, "abc"]
