"""Rules, sketches, as-of features, trailing anomalies, calendar forecasts and chart grains against brute force."""

import random
import statistics
from collections import Counter
from dataclasses import replace
from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from conftest import rows
from lakeops.operators import asof, incremental, rules
from lakeops.contracts import Table, columns
from lakeops.plans import analytics, charts, forecast

DAY = date(2024, 1, 1)


def day(k):
    return DAY + timedelta(days=k)


def test_rules_against_brute_force(spark):
    rng = random.Random(1)
    left = [(rng.choice([None, "", "hot", *(f"k{i}" for i in range(30))]), rng.choice([None, *range(40)])) for _ in range(400)]
    right = [(k,) for k in ("hot", *(f"k{i}" for i in range(20)), None, "k1")]
    frames = {"l": spark.createDataFrame(left, "k string, n int").repartition(5), "r": spark.createDataFrame(right, "key string")}
    checked = [rules.Rule("l", "required", "k"), rules.Rule("l", "required", "n"), rules.Rule("l", "unique", "k"), rules.Rule("l", "unique", "n"),
               rules.Rule("l", "reference", "k", "r.key"), rules.Rule("r", "unique", "key")]
    keys, numbers = [k for k, _ in left if k is not None], [n for _, n in left if n is not None]
    known = {k for (k,) in right}
    expected = [
        ("required k", 400, sum(not k for k, _ in left)),
        ("required n", 400, 400 - len(numbers)),
        ("unique k", len(keys), len(keys) - len(set(keys))),
        ("unique n", len(numbers), len(numbers) - len(set(numbers))),
        ("reference k in r.key", len(keys), sum(k not in known for k in keys)),
        ("unique key", 22, 1),
    ]
    got = rules.report(frames, checked).collect()
    assert [(r.rule, r.checked, r.failed) for r in got] == expected and all(r.status == ("bad" if r.failed else "ok") for r in got)
    empty = {name: df.limit(0) for name, df in frames.items()}
    assert {(r.checked, r.failed, r.status) for r in rules.report(empty, checked).collect()} == {(0, 0, "ok")}
    with pytest.raises(ValueError):
        rules.report(frames, [rules.Rule("l", "odd", "k")])


def test_sketches_merge_over_dates_within_their_error(spark):
    df = spark.range(60_000).select((F.col("id") % 20_000).cast("string").alias("k"), F.expr("date_add(date'2024-01-01', CAST(id % 7 AS INT))").alias("event_date"))
    sketches = rules.distinct_sketches(df, ["k"])
    assert sketches.count() == 7
    total = rules.distinct_estimates(sketches).first().distinct_values
    assert abs(total - 20_000) <= rules.SKETCH_ERROR * 20_000
    for r in rules.distinct_estimates(sketches, "event_date").collect():
        exact = df.where(F.col("event_date") == r.event_date).select("k").distinct().count()
        assert abs(r.distinct_values - exact) <= rules.SKETCH_ERROR * exact
    assert rules.distinct_estimates(rules.distinct_sketches(df.limit(0), ["k"])).count() == 0


@pytest.mark.parametrize("strict", [True, False])
@pytest.mark.parametrize("limit", [0, 1 << 20])
def test_as_of_values_have_no_future(spark, strict, limit):
    rng = random.Random(3)
    key = lambda: rng.choice(["hot", "hot", None, *"abcd"])
    facts = [(k, key(), rng.choice([None, *map(day, range(12))])) for k in range(300)]
    told = [(key(), rng.choice([None, *map(day, range(12))]), rng.randrange(100), k) for k in range(40)]
    history = asof.last_of_day(spark.createDataFrame(told, "k string, day date, v int, at int"), "k", "day", ["v"], ["at"])
    got = asof.as_of(spark.createDataFrame(facts, "id int, k string, day date"), history, "k", "day", ["v"], strict=strict, limit_bytes=limit)
    expected = []
    for i, k, d in facts:
        before = [(day_, at, v) for key_, day_, v, at in told if k is not None and d is not None and key_ == k and day_ is not None and (day_ < d or day_ == d and not strict)]
        last = max(before, default=None)
        expected.append((i, k, d, last and last[2], last and last[0]))
    assert rows(got) == sorted(expected, key=repr)


def test_a_hot_key_reaches_the_window_once_per_day(spark):
    facts = spark.range(1000).select(F.lit("hot").alias("k"), F.expr("date_add(date'2024-01-01', CAST(id % 3 AS INT))").alias("day"))
    history = spark.createDataFrame([("hot", day(0), 1), ("hot", day(1), 2)], "k string, day date, v int")
    known = asof.as_of(facts, history, "k", "day", ["v"], limit_bytes=0)
    assert rows(known.groupBy("day", "v").count()) == sorted([(day(0), None, 334), (day(1), 1, 333), (day(2), 2, 333)], key=repr)


def _orders(spark, items):
    data = [(f"e{i}", p, "WH-N1", q, d) for i, (p, q, d) in enumerate(items)]
    return spark.createDataFrame(data, "event_id string, product_id string, warehouse_id string, qty bigint, event_date date")


def test_features_as_known_use_the_day_before(spark):
    orders = _orders(spark, [("p", 1, day(0)), ("p", 2, day(2)), ("q", 3, day(2))]).withColumn("order_id", F.col("event_id"))
    noon = datetime(2024, 1, 1, 12)
    risks = spark.createDataFrame([("a", noon, "p", 0.1, 0.5, day(1)), ("b", noon, "p", 0.2, 0.5, day(1)), ("c", noon, "p", 0.9, 0.5, day(2))],
                                  "event_id string, event_ts timestamp_ntz, product_id string, risk_score double, confidence double, event_date date")
    demand = spark.createDataFrame([("d", noon, "q", 7, day(0))], "event_id string, event_ts timestamp_ntz, product_id string, forecast_qty bigint, event_date date")
    got = analytics.features_as_known(orders, risks, demand)
    assert rows(got, "event_id", "risk_score", "risk_since", "forecast_qty") == [("e0", None, None, None), ("e1", 0.2, day(1), None), ("e2", None, None, 7)]


def test_trailing_anomalies_know_no_later_day(spark):
    rng = random.Random(5)
    items = [(p, rng.randrange(1, 40) + (400 if rng.random() < 0.05 else 0), day(rng.randrange(90))) for p in "pq" for _ in range(150)]
    got = {(r.product_id, r.event_date): (r.qty, r.mean_qty, r.sd_qty) for r in analytics.trailing_anomalies(_orders(spark, items), 20, 5, 2.0).collect()}
    daily = Counter()
    for p, q, d in items:
        daily[p, d] += q
    expected = {}
    for (p, d), q in daily.items():
        before = [daily[p, d - timedelta(days=k)] for k in range(1, 21) if (p, d - timedelta(days=k)) in daily]
        if len(before) >= 5 and statistics.stdev(before) > 0 and abs(q - statistics.mean(before)) > 2 * statistics.stdev(before):
            expected[p, d] = (q, pytest.approx(statistics.mean(before)), pytest.approx(statistics.stdev(before)))
    assert expected and got == expected
    cut = [i for i in items if i[2] < day(60)]
    early = {k for k in got if k[1] < day(60)}
    assert {(r.product_id, r.event_date) for r in analytics.trailing_anomalies(_orders(spark, cut), 20, 5, 2.0).collect()} == early


def test_calendar_forecast_counts_days_without_orders(spark):
    rng = random.Random(8)
    items = [(p, rng.randrange(1, 30), day(rng.randrange(lo, hi))) for p, lo, hi in (("p", 0, 40), ("old", 0, 5), ("new", 37, 40)) for _ in range(25)]
    got = {r.product_id: r.forecast_qty for r in forecast.demand_forecast(_orders(spark, items), "2024-03-01 00:00:00", 10, calendar=True).collect()}
    newest = max(d for *_, d in items)
    for product in ("p", "old", "new"):
        own = [(q, d) for p, q, d in items if p == product]
        span = min(10, (newest - min(d for _, d in own)).days + 1)
        assert got[product] == round(sum(q for q, d in own if (newest - d).days < 10) / span)
    assert got["old"] == 0
    assert forecast.demand_forecast(_orders(spark, items).limit(0), "2024-03-01 00:00:00", 10, calendar=True).count() == 0


def test_dense_history_fills_each_gap_once(spark):
    history = spark.createDataFrame([("p", "g", day(0), 5), ("p", "g", day(3), 7), ("q", "g", day(4), 1)], "product_id string, region string, event_date date, qty bigint")
    got = rows(forecast.dense_history(history, F.lit(day(5)).cast("date")), "product_id", "event_date", "qty")
    assert got == sorted([("p", day(k), {0: 5, 3: 7}.get(k, 0)) for k in range(6)] + [("q", day(4), 1), ("q", day(5), 0)], key=repr)


@pytest.mark.parametrize(("grain", "first"), [("day", date(2024, 2, 14)), ("week", date(2024, 2, 12)), ("month", date(2024, 2, 1)), ("quarter", DAY), ("year", DAY)])
def test_chart_grains(spark, grain, first):
    df = spark.createDataFrame([(date(2024, 2, 14),), (date(2024, 2, 14),), (date(2025, 7, 1),)], "event_date date")
    chart = replace(charts.CHARTS["daily_orders"], grain=grain)
    got = [tuple(r) for r in charts.chart_query(df, chart).collect()]
    assert got[0] == (first, 2) and len(got) == 2
    with pytest.raises(ValueError):
        charts.chart_query(df, replace(chart, grain="decade"))


def test_newest_mark_of_rows(spark):
    table = Table("a.b", columns("ts TIMESTAMP"), mark="ts")
    df = spark.createDataFrame([(datetime(2024, 1, 1), DAY), (None, DAY), (datetime(2024, 1, 2), DAY)], table.schema)
    assert incremental.newest(df, table).first().mark == datetime(2024, 1, 2)
