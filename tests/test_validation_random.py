"""Random values against a lax validating model, where one is installed."""

import json
import math
import random
from datetime import date, datetime, timezone

import pytest
from pyspark.sql import functions as F

from lakeops.contracts import Column, Feed
from lakeops.operators import conform

pydantic = pytest.importorskip("pydantic")

PYTHON_TYPES = {"LONG": int, "DOUBLE": float, "STRING": str, "TIMESTAMP": datetime, "DATE": date}


def _number_text(rng):
    sign = rng.choice(["", "", "+", "-", "--", " "])
    body = rng.choice(["", "0", "00"]) + "".join(rng.choice("0123456789_") for _ in range(rng.randrange(0, 8)))
    tail = rng.choice(["", "", ".", ".0", ".00", ".5", "e3", "E-2", " ", "\t", "f"])
    return rng.choice(["", " "]) + sign + body + tail


def _time_text(rng):
    day = f"{rng.choice(['0000', '0001', '1969', '2024', '9999', '204'])}-{rng.randrange(0, 14):02d}-{rng.randrange(0, 33):02d}"
    if rng.random() < 0.2:
        return day + rng.choice(["", "", " ", "Z"])
    clock = f"{rng.randrange(0, 26):02d}:{rng.randrange(0, 62):02d}"
    seconds = rng.choice(["", ":05", ":59", ":60", ":5"])
    fraction = rng.choice(["", "", ".5", ",25", ".123456", ".1234567", "."]) if seconds else ""
    zone = rng.choice(["", "", "", "Z", "z", "+05:30", "-0800", "+23:59", "+24:00", "+05", " Z", "-00:00"])
    return day + rng.choice("T t_-") + clock + seconds + fraction + zone


def _value(rng):
    return rng.choice(
        [
            lambda: rng.randrange(-(10**6), 10**6),
            lambda: rng.randrange(-(10**19), 10**19),
            lambda: float(rng.randrange(-1000, 1000)),
            lambda: rng.uniform(-1e6, 1e6),
            lambda: rng.uniform(-1, 1) * 10 ** rng.randrange(0, 25),
            lambda: round(rng.uniform(-1e4, 1e4), 2),
            lambda: _number_text(rng),
            lambda: _number_text(rng),
            lambda: _time_text(rng),
            lambda: _time_text(rng),
            lambda: _time_text(rng),
            lambda: str(rng.randrange(-(10**11), 10**14)),
            lambda: rng.choice([True, False, None, "", "true", "null", "nan", "NaN", "inf", "-Infinity", [], {}, [1], {"a": 1}, "é"]),
        ]
    )()


def _expected(model, kind, value):
    """The model's value in the form the table stores, None when the model rejects it, ``...`` when the table cannot hold it."""
    try:
        got = model(v=value).v
    except pydantic.ValidationError:
        return None
    if kind == "LONG" and not -(2**63) <= got < 2**63:
        return None  # no 64-bit column holds it
    if kind == "TIMESTAMP" and got.tzinfo:
        try:
            return got.astimezone(timezone.utc).replace(tzinfo=None)
        except OverflowError:
            return ...
    return got


def _same(kind, got, expected):
    if expected is None or got is None:
        return got is expected
    if kind == "DOUBLE":
        return got == expected or (math.isnan(got) and math.isnan(expected))
    if kind == "TIMESTAMP":  # the model takes epoch floats with float precision
        return abs((got - expected).total_seconds()) <= 1e-5
    return got == expected


@pytest.mark.parametrize("kind", PYTHON_TYPES)
def test_random_values(spark, kind):
    rng = random.Random(f"{kind}-1")
    values = [_value(rng) for _ in range(4000)]
    model = pydantic.create_model("M", v=(PYTHON_TYPES[kind], ...))
    feed = Feed("t", "t", "m.t", (Column("event_ts", "TIMESTAMP"), Column("v", kind)), "event_ts")
    bodies = [(i, json.dumps({"event_ts": "2024-01-01", "v": v})) for i, v in enumerate(values)]
    decoded = conform.decode(spark.createDataFrame(bodies, "n int, body string"), feed, keep=("n",))
    got = {r.n: r for r in decoded.select("n", "v", F.col("reason").isNull().alias("valid")).collect()}
    wrong = []
    for i, value in enumerate(values):
        expected = _expected(model, kind, json.loads(json.dumps(value)))
        if expected is ...:
            continue
        if not _same(kind, got[i].v, expected) or got[i].valid != (expected is not None):
            wrong.append((value, expected, got[i].v))
    assert not wrong, "; ".join(map(str, wrong[:12]))
