"""Hash-only dedupe, joins with hot keys, marts and dimensions kept load by load."""

import random
import shutil
from collections import Counter
from datetime import date, timedelta

from pyspark.sql import functions as F

from conftest import rows
from lakeops.contracts import Table, columns
from lakeops.operators import bit_table, dedupe, joins
from lakeops.plans import current_state, dims, stored_marts
from lakeops.sources import tables

DAY = date(2024, 1, 1)


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


# Dedupe


def test_bit_table_never_misses_a_member(spark):
    keys = spark.range(5000).select(F.col("id").cast("string").alias("k"))
    table = bit_table.bit_table(keys.where("cast(k as int) < 700").select(bit_table.key_hash("k").alias("__h")), slots=64, mine=None)
    marked = bit_table.with_marks(keys, bit_table.key_hash("k"), table, slots=64)
    assert marked.columns == ["k", "__mine"] and marked.count() == 5000
    assert marked.where("__mine AND cast(k as int) < 700").count() == 700
    assert 0 < marked.where("NOT __mine").count() < 4300  # 4096 bits for 700 keys: most others are told apart
    assert table.count() <= 64
    assert bit_table.with_marks(keys, bit_table.key_hash("k"), table.limit(0), slots=64).where("__mine").count() == 0


def test_dedupe_shuffles_hashes_first_and_sorts_no_whole_load(spark):
    df = spark.range(10).select(F.col("id").cast("string").alias("event_id"), F.lit("x").alias("text"))
    for plan in (plan_of(dedupe.one_row_per(df, "event_id")), plan_of(dedupe.new_once(df, df, "event_id"))):
        assert "SortAggregate" not in plan and "ObjectHashAggregate" not in plan
        assert "WindowGroupLimit" in plan and "Partial" in plan  # a hot key's copies are thinned out before the shuffle


def test_a_key_of_a_million_copies(spark):
    n = 1_500_000
    df = spark.range(n).select(
        F.when(F.col("id") % 3 != 0, "hot").otherwise(F.concat(F.lit("e"), F.col("id"))).alias("event_id"),
        F.pmod(F.xxhash64("id"), F.lit(1000)).alias("a"),
        F.concat(F.lit("s"), F.col("id") % 7).alias("b"),
    )
    got = dedupe.one_row_per(df, "event_id")
    assert got.count() == n // 3 + 1
    least = df.where("event_id = 'hot'").agg(F.min(F.struct("a", "b")).alias("m")).first().m
    assert rows(got.where("event_id = 'hot'")) == [("hot", least.a, least.b)]
    assert dedupe.new_once(df, df.where("event_id = 'hot' OR a < 500"), "event_id").where("event_id = 'hot'").count() == 0


def test_dedupe_of_random_rows_with_null_keys_and_tables(spark):
    rng = random.Random(5)
    data = [(rng.choice([None, "hot", *(f"k{i}" for i in range(60))]), rng.choice([None, 1, 2, 3]), rng.choice("ab")) for _ in range(500)]
    stored = {rng.choice([None, "hot", *(f"k{i}" for i in range(60))]) for _ in range(20)}
    df = spark.createDataFrame(data, "k string, n int, c string").repartition(7)
    known = spark.createDataFrame([(k, 1) for k in stored for _ in range(3)], "k string, other int")
    least = {}
    for k, *rest in data:
        order = (rest[0] is not None, rest[0] or 0, rest[1])
        if k not in least or order < least[k][0]:
            least[k] = (order, tuple(rest))
    once = sorted(((k, *v) for k, (_, v) in least.items()), key=repr)
    assert rows(dedupe.one_row_per(df, "k")) == once
    left = [r for r in once if r[0] is None or r[0] not in stored]  # NULL equals no stored key
    assert rows(dedupe.not_stored(dedupe.one_row_per(df, "k"), known, "k")) == left
    assert rows(dedupe.new_once(df, known, "k")) == left
    assert rows(dedupe.new_once(df, known.limit(0), "k")) == once
    assert dedupe.new_once(df.limit(0), known, "k").count() == 0 and dedupe.one_row_per(df.limit(0), "k").columns == ["k", "n", "c"]
    assert rows(dedupe.one_row_per(df.select("k"), "k")) == sorted(((k,) for k in least), key=repr)


# Joins


def test_frequent_keys_are_all_found(spark):
    rng = random.Random(2)
    data = [rng.choice(["a", "a", "b", None, f"x{rng.randrange(400)}"]) for _ in range(6000)]
    df = spark.createDataFrame([(k,) for k in data], "k string").repartition(9)
    found = joins.frequent_keys(df, "k", 0.05)
    assert found == sorted(k for k, n in Counter(data).items() if k and n >= 0.05 * len(data))
    assert joins.frequent_keys(df.limit(0), "k") == []


def test_only_hot_keys_of_a_large_dimension_are_repeated(spark):
    facts = spark.range(4000).select(
        F.col("id").cast("string").alias("event_id"),
        F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") % 5 == 0, None).otherwise(F.concat(F.lit("k"), F.col("id"))).alias("k"),
    )
    dimension = spark.createDataFrame([("hot", "h", 0)] + [(f"k{i}", f"v{i}", i) for i in range(0, 4000, 2)], "k string, v string, _n int")
    joined = joins.with_dimension(facts, dimension, "k", spread_by="event_id", limit_bytes=0, salts=16)
    small = joins.with_dimension(facts, dimension, "k", spread_by="event_id")
    assert rows(joined) == rows(small) and joined.count() == 4000
    plan = joined._jdf.queryExecution().optimizedPlan().toString()
    salted = [line for line in plan.splitlines() if "explode" in line][0]
    assert "(k#" in salted and "= hot) THEN 15" in salted
    repeated = dimension.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.when(F.col("k").isin(joins.frequent_keys(facts, "k")), 16).otherwise(1) - 1)))
    assert repeated.count() == dimension.count() + 15  # one hot key


def test_broadcast_bound_is_measured_without_text_of_rows(spark):
    df = spark.createDataFrame([("x" * 1000, 1, [1, 2], None)] * 10, "a string, b long, c array<int>, d date")
    assert joins.fits_broadcast(df, 20_000) and not joins.fits_broadcast(df, 10_000)
    assert joins.fits_broadcast(df.limit(0), 0)


# Marts

RETURNS = Table("returns.small_returns", columns("order_id STRING, event_date DATE"))
ORDERS = Table("orders.small_orders", columns("order_id STRING, warehouse_id STRING, event_date DATE"))
MART = stored_marts.returns_mart("small", RETURNS, ORDERS)


def _plain_mart(returns, orders):
    totals, first = Counter(), {}
    for order_id, day in returns:
        for other, warehouse, _ in orders:
            if order_id is not None and order_id == other:
                totals[warehouse] += 1
                first[warehouse] = min(day, first.get(warehouse, day))
    return sorted(((w, n, first[w]) for w, n in totals.items()), key=repr)


def _some(rng, n, *columns):
    key = lambda: rng.choice(["hot", "hot", None, *(f"o{i}" for i in range(25))])
    return [(key(), *(c(rng) for c in columns), DAY + timedelta(days=rng.randrange(4))) for _ in range(n)]


def test_stored_mart_follows_new_replaced_and_lost_loads(spark, warehouse):
    rng = random.Random(9)
    place = lambda r: r.choice(["WH-N1", "WH-S1", None])
    returns, orders = {}, {}

    def store(table, kept, load, data):
        kept[load] = data
        tables.remove(spark, f"{tables.table_path(warehouse, table.name)}/gone")
        for day in {d[-1] for d in data} | {DAY + timedelta(days=k) for k in range(4)}:
            tables.remove(spark, f"{tables.table_path(warehouse, table.name)}/event_date={day}/load_id={load}")
        tables.append(spark.createDataFrame(data, table.schema), warehouse, table, load)

    def check(read_returns, read_orders):
        assert stored_marts.refresh(spark, warehouse, MART) == [read_returns, read_orders]
        expected = _plain_mart([r for part in returns.values() for r in part], [o for part in orders.values() for o in part])
        assert rows(stored_marts.read(spark, warehouse, MART)) == expected

    assert stored_marts.read(spark, warehouse, MART).count() == 0
    check(set(), set())
    store(RETURNS, returns, "a", _some(rng, 60))
    check({"a"}, set())
    store(ORDERS, orders, "x/1", _some(rng, 50, place))
    check(set(), {"x/1"})
    store(RETURNS, returns, "b", _some(rng, 30))
    store(ORDERS, orders, "y=2", _some(rng, 30, place))
    check({"b"}, {"y=2"})
    check(set(), set())
    store(RETURNS, returns, "b", _some(rng, 10))
    check({"b"}, set())
    store(ORDERS, orders, "x/1", _some(rng, 20, place))
    store(RETURNS, returns, "a", _some(rng, 5))
    check({"a"}, {"x/1"})
    for day in range(4):
        tables.remove(spark, f"{tables.table_path(warehouse, RETURNS.name)}/event_date={DAY + timedelta(days=day)}/load_id=b")
    del returns["b"]
    check(set(), set())
    # a refresh that died before it recorded its loads is repeated and counts nothing twice
    shutil.rmtree(stored_marts._path(warehouse, MART, "versions"))
    check({"a"}, {"x/1", "y=2"})


def test_refresh_reads_only_the_new_load(spark, warehouse):
    mart = stored_marts.count_mart("days", RETURNS, "event_date date", "n")
    tables.append(spark.createDataFrame([("a", DAY)] * 3, RETURNS.schema), warehouse, RETURNS, "one")
    stored_marts.refresh(spark, warehouse, mart)
    tables.append(spark.createDataFrame([("b", DAY)] * 2, RETURNS.schema), warehouse, RETURNS, "two")
    _, changed, gone = stored_marts.pending(spark, warehouse, mart)
    assert changed == [{"two"}] and gone == [set()]
    frame = stored_marts._frame(spark, warehouse, RETURNS, 0, changed[0])
    files = plan_of(mart.partial([frame], 0)).split("PartitionFilters: [")[1].split("]")[0]
    assert "load_id" in files and frame.count() == 2
    stored_marts.refresh(spark, warehouse, mart)
    assert rows(stored_marts.read(spark, warehouse, mart)) == [(DAY, 5)]


def test_declared_marts_name_stored_tables():
    assert all(m.name == name and all(tables.contract_of(s).name == s for s in m.sources) for name, m in stored_marts.MARTS.items())


# Current dimensions

PRODUCT = Table("dimensions.some_product", columns("product_id STRING, name STRING, unit_cost INT, event_date DATE"), mark="event_date")


def test_current_state_equals_the_recomputation(spark, warehouse):
    rng = random.Random(4)
    held = {}

    def store(load, n):
        held[load] = [(f"p{rng.randrange(12)}", rng.choice([None, "a", "b", "c"]), rng.choice([None, 1, 2]), DAY + timedelta(days=rng.randrange(5))) for _ in range(n)]
        for day in range(5):
            tables.remove(spark, f"{tables.table_path(warehouse, PRODUCT.name)}/event_date={DAY + timedelta(days=day)}/load_id={load}")
        tables.append(spark.createDataFrame(held[load], PRODUCT.schema), warehouse, PRODUCT, load)

    def check(how, loads):
        assert current_state.update(spark, warehouse, PRODUCT, "product_id") == (how, loads)
        dim = spark.createDataFrame([r for part in held.values() for r in part], PRODUCT.schema)
        assert rows(current_state.read(spark, warehouse, PRODUCT, "product_id")) == rows(dims.current(dim, "product_id"))

    assert current_state.read(spark, warehouse, PRODUCT, "product_id").count() == 0
    store("one", 20)
    check("rebuilt", {"one"})
    check("nothing", set())
    store("two", 30)
    check("merged", {"two"})
    store("three", 3)
    store("four", 4)
    check("merged", {"three", "four"})
    store("two", 5)  # replaced: a maximum cannot be taken back
    check("rebuilt", {"one", "two", "three", "four"})
    # an update that died before it recorded its loads
    store("five", 9)
    number, _ = current_state._held(spark, warehouse, PRODUCT)
    spark.range(3).write.parquet(current_state._path(warehouse, PRODUCT, "state", number + 1))
    check("merged", {"five"})


def test_update_reads_only_the_new_load(spark, warehouse):
    tables.append(spark.createDataFrame([("p", "a", 1, DAY)], PRODUCT.schema), warehouse, PRODUCT, "one")
    tables.append(spark.createDataFrame([("q", "b", 2, DAY)], PRODUCT.schema), warehouse, PRODUCT, "two")
    new = current_state.delta(spark, warehouse, PRODUCT, {"two"})
    assert rows(new, "product_id") == [("q",)]
    assert "load_id" in plan_of(new).split("PartitionFilters: [")[1].split("]")[0]


def test_merging_states_in_any_order_gives_the_same(spark):
    a = spark.createDataFrame([("p", "old", None, DAY)], PRODUCT.schema)
    b = spark.createDataFrame([("p", None, 7, DAY + timedelta(days=2)), ("q", None, None, DAY)], PRODUCT.schema)
    parts = [current_state.reduced(x, "product_id", ["name", "unit_cost"]) for x in (a, b)]
    one, two = (current_state.merged(x, y, "product_id", ["name", "unit_cost"]) for x, y in (parts, parts[::-1]))
    assert rows(one) == rows(two) == rows(current_state.reduced(a.unionByName(b), "product_id", ["name", "unit_cost"]))
    assert one.count() == 2
