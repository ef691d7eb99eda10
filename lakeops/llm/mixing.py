"""Mixing sources to target weights by pivotal dependent rounding, with DataFrame functions only.

Sources in code-point order (null last) weigh 5, 2, 1, 5, 2, 1, ... and share the words of all documents.  No target exceeds ``MOST`` times the words of its
source; the excess is shared among the others by weight.  So target = least(MOST * size, level * weight) for one level that makes the targets
add up to all words.

Every document of a source should be taken rate = target / size times.  The whole part is taken outright.  The fractional parts of a source's
documents are rounded together: two of them exchange words (one's share of itself rises, the other's falls by as many words) in a
random direction that keeps both expectations, until one is taken fully or not at all; the other meets the next.  Documents are dealt
into buckets of about ``FAN``.  In a bucket, from the largest document down, each meets all the smaller ones, which share one fraction, so that
large documents are finished first and a small one is left over.  The leftovers of ``FAN`` buckets meet in pairs on the next level of the tree, up to one
per source, which a last draw finishes.  No words are lost on the way, so a source misses its target by less than that last document.

Draws are hashes of the documents' ids and the seed: reruns agree, whatever the partitioning.  Rows with equal source, id and size are exchangeable;
they are counted, share one fraction, and are spread out again at the end, so that a repeated row never fills a bucket.
Null text has size 0 and is taken 0 words.  Null ids and null sources are ordinary values.  An empty table gives an empty mix.
"""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from lakeops.llm.scratch import stored

WEIGHTS = (5, 2, 1)
MOST = 3
FAN = 64
SEED = 42
SOURCE_ROWS = 100_000  # a broadcast source table has at most so many rows
EXPAND = 10_000
WORD = r"[^\x20\x09-\x0D]+"


def _running(df: DataFrame, order: list[Column], values: list[str]) -> DataFrame:
    """``df`` with ``rank`` (from 1) and, for each value, ``<value>_before``: its sum over the rows before, in the given total order.

    Ranges of rows are summed in parallel; only one row per range meets in a single place.
    """
    parts = stored(df.repartitionByRange(*order).withColumn("__part", F.spark_partition_id()))
    sums = parts.groupBy("__part").agg(F.count("*").alias("__n"), *[F.sum(v).alias(f"__{v}") for v in values])
    before = Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    zero = lambda c: F.coalesce(c, F.lit(0))
    offsets = sums.select("__part", zero(F.sum("__n").over(before)).alias("__rank"), *[zero(F.sum(f"__{v}").over(before)).alias(f"__{v}_before") for v in values])
    inside = Window.partitionBy("__part").orderBy(*order)
    ahead = inside.rowsBetween(Window.unboundedPreceding, -1)
    out = parts.join(offsets, "__part").withColumn("rank", F.col("__rank") + F.row_number().over(inside))
    for v in values:
        out = out.withColumn(f"{v}_before", F.col(f"__{v}_before") + zero(F.sum(v).over(ahead)))
    return out.select(*df.columns, "rank", *[f"{v}_before" for v in values])


def targets(sources: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST) -> DataFrame:
    """(source, source_size, docs, target) of (source, source_size, docs)."""
    ranked = _running(sources, [F.col("source").asc_nulls_last()], [])
    weight = F.element_at(F.array(*map(F.lit, weights)), (F.pmod(F.col("rank") - 1, F.lit(len(weights))) + 1).cast("int"))
    limited = stored(ranked.withColumn("weight", weight.cast("long")).withColumn("limit", most * F.col("source_size")).drop("rank"))
    # Sources reach their limits in the order of limit / weight; the level is set where the next one does not.
    filled = stored(_running(limited, [F.col("limit") / F.col("weight"), F.col("source").asc_nulls_last()], ["limit", "weight"]))
    total = limited.agg(F.sum("source_size").alias("all_words"), F.sum("weight").alias("all_weights"))
    level = (F.col("all_words") - F.col("limit_before")) / (F.col("all_weights") - F.col("weight_before"))
    free = filled.crossJoin(F.broadcast(total)).withColumn("level", level).filter(F.col("limit") > F.col("weight") * F.col("level"))
    level = free.agg(F.min_by("level", "rank").alias("level"))  # one row
    target = F.least(F.col("limit").cast("double"), F.coalesce(F.col("weight") * F.col("level"), F.col("limit").cast("double")))
    return filled.crossJoin(F.broadcast(level)).select("source", "source_size", "docs", target.alias("target"))


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    return F.transform(F.array(value), body)[0]


def _draw(seed: int, *columns: Column) -> Column:
    """A number in (0, 1) that depends on the columns only."""
    return (F.pmod(F.xxhash64(F.lit(seed), *columns), F.lit(1 << 40)) + 0.5) / float(1 << 40)


def _with_p(item: Column, p: Column) -> Column:
    return item.withField("p", p)


def _meet(state: Column, new: Column, seed: int) -> Column:
    """The unfinished document of the state and a new one exchange words until one of them is finished."""

    def exchange(m: Column) -> Column:
        a, b, up, down, rise = m["a"], m["b"], m["up"], m["down"], m["rise"]
        room_a, room_b = (1 - a["p"]) * a["size"], (1 - b["p"]) * b["size"]
        a_up = F.when(up >= room_a, F.lit(1.0)).otherwise(a["p"] + up / a["size"])
        a_down = F.when(down >= a["p"] * a["size"], F.lit(0.0)).otherwise(a["p"] - down / a["size"])
        b_down = F.when(up >= b["p"] * b["size"], F.lit(0.0)).otherwise(b["p"] - up / b["size"])
        b_up = F.when(down >= room_b, F.lit(1.0)).otherwise(b["p"] + down / b["size"])
        return F.array(_with_p(a, F.when(rise, a_up).otherwise(a_down)), _with_p(b, F.when(rise, b_down).otherwise(b_up)))

    def moves(a: Column, b: Column) -> Column:
        up = F.least((1 - a["p"]) * a["size"], b["p"] * b["size"])
        down = F.least(a["p"] * a["size"], (1 - b["p"]) * b["size"])
        return _let(
            F.struct(up.alias("up"), down.alias("down")),
            lambda t: F.struct(
                a.alias("a"), b.alias("b"), t["up"].alias("up"), t["down"].alias("down"),
                (_draw(seed, a["id"], a["size"], b["id"], b["size"]) * (t["up"] + t["down"]) < t["down"]).alias("rise"),
            ),
        )

    finished = lambda x: (x["p"] <= 0) | (x["p"] >= 1)
    met = lambda pair: F.struct(
        F.concat(state["done"], F.filter(pair, finished)).alias("done"), F.element_at(F.filter(pair, lambda x: ~finished(x)), 1).alias("open")
    )
    after = _let(_let(moves(state["open"], new), exchange), met)
    return F.when(state["open"].isNull(), F.struct(state["done"].alias("done"), new.alias("open"))).otherwise(after)


def _settle(state: Column, x: Column, seed: int) -> Column:
    """A document exchanges words with the rest of its bucket, whose smaller documents all share the fraction ``p``.

    The document is finished, or all of the rest is (``rest`` then holds whether it is taken) and the document stays open.
    """
    p, w = state["p"], x["size"].cast("double")
    others = state["left"] - w

    def exchange(t: Column) -> Column:
        up, down, rise = t["up"], t["down"], t["rise"]
        own = F.when(rise, F.when(up >= (1 - p) * w, 1.0).otherwise(p + up / w)).otherwise(F.when(down >= p * w, 0.0).otherwise(p - down / w))
        rest = F.when(rise, F.when(up >= p * others, 0.0).otherwise(p - up / others)).otherwise(
            F.when(down >= (1 - p) * others, 1.0).otherwise(p + down / others)
        )
        return F.struct(own.alias("own"), rest.alias("rest"))

    up, down = F.least((1 - p) * w, p * others), F.least(p * w, (1 - p) * others)
    rise = lambda t: F.struct(t["up"].alias("up"), t["down"].alias("down"), (_draw(seed, x["id"], x["size"]) * (t["up"] + t["down"]) < t["down"]).alias("rise"))
    whole = lambda v: (v <= 0) | (v >= 1)
    none = state["open"]  # null until a document stays open, which happens once
    after = lambda e: F.struct(
        F.when(whole(e["own"]), F.concat(state["done"], F.array(_with_p(x, e["own"])))).otherwise(state["done"]).alias("done"),
        F.when(whole(e["own"]), none).otherwise(_with_p(x, e["own"])).alias("open"),
        e["rest"].alias("p"),
        others.alias("left"),
        F.when(whole(e["rest"]), e["rest"]).otherwise(state["rest"]).alias("rest"),
    )
    met = _let(_let(_let(F.struct(up.alias("up"), down.alias("down")), rise), exchange), after)
    settled = F.struct(F.concat(state["done"], F.array(_with_p(x, state["rest"]))).alias("done"), none.alias("open"), p.alias("p"), others.alias("left"), state["rest"].alias("rest"))
    last = F.struct(state["done"].alias("done"), _with_p(x, p).alias("open"), p.alias("p"), others.alias("left"), state["rest"].alias("rest"))
    return F.when(state["rest"].isNotNull(), settled).when(others <= 0, last).otherwise(met)


def _bucketed(items: DataFrame) -> tuple[DataFrame, str]:
    """(source, bucket, items): the items of a bucket, large documents first; and the type of an item."""
    largest = F.sort_array(F.transform(F.collect_list("item"), lambda x: F.struct(-x["size"], x.alias("item"))))
    rows = items.groupBy("source", "bucket").agg(F.transform(largest, lambda x: x["item"]).alias("items"))
    return rows, items.schema["item"].dataType.simpleString()


def _settle_buckets(items: DataFrame, seed: int) -> DataFrame:
    """(source, bucket, done, open) of items (source, bucket, item) that have one fraction in each bucket."""
    rows, kind = _bucketed(items)
    words = F.aggregate("items", F.lit(0.0), lambda s, x: s + x["size"])
    start = F.struct(
        F.expr(f"CAST(array() AS array<{kind}>)").alias("done"),
        F.expr(f"CAST(NULL AS {kind})").alias("open"),
        F.col("items")[0]["p"].alias("p"),
        words.alias("left"),
        F.lit(None).cast("double").alias("rest"),
    )
    return rows.select("source", "bucket", F.aggregate("items", start, lambda s, x: _settle(s, x, seed)).alias("state")).select("source", "bucket", "state.done", "state.open")


def _meet_buckets(items: DataFrame, seed: int) -> DataFrame:
    """(source, bucket, done, open) of items (source, bucket, item) of any fractions."""
    rows, kind = _bucketed(items)
    start = F.expr(f"named_struct('done', CAST(array() AS array<{kind}>), 'open', CAST(NULL AS {kind}))")
    return rows.select("source", "bucket", F.aggregate("items", start, lambda s, x: _meet(s, x, seed)).alias("state")).select("source", "bucket", "state.*")


def round_copies(items: DataFrame, most_docs: int, seed: int = SEED, fan: int = FAN) -> DataFrame:
    """(source, item, one): whether each fractional item gets its copy, for items (source, docs, item with id, size, p, rows).

    ``most_docs`` is the largest number of documents of a source: it sets the number of levels.
    """
    buckets = F.ceil(F.col("docs") / fan)
    dealt = items.withColumn("bucket", F.pmod(F.xxhash64(F.lit(seed), "item.id", "item.size"), buckets)).select("source", "bucket", "item")
    single = F.col("item.rows") == 1
    folded = stored(_settle_buckets(dealt.filter(single), seed + 1).unionByName(_meet_buckets(dealt.filter(~single), seed + 1)))
    done = folded.select("source", F.explode("done").alias("item"))
    up = lambda level: level.filter("open IS NOT NULL").select("source", F.floor(F.col("bucket") / fan).alias("bucket"), F.col("open").alias("item"))
    level = up(folded)
    for depth in range(max(1, math.ceil(math.log(max(1, -(-most_docs // fan)), fan)))):
        folded = stored(_meet_buckets(level, seed + 2 + depth))
        done = done.unionByName(folded.select("source", F.explode("done").alias("item")))
        level = up(folded)
    last = level.withColumn("item", _with_p(F.col("item"), F.when(_draw(seed, F.col("item.id")) < F.col("item.p"), 1.0).otherwise(0.0)))
    done = done.unionByName(last.select("source", "item"))
    return done.select("source", "item", (F.col("item.p") >= 1).cast("long").alias("one"))


def mix(
    docs: DataFrame, id: str = "doc_id", text: str = "text", source: str = "source", weights: tuple[int, ...] = WEIGHTS, most: int = MOST, seed: int = SEED
) -> DataFrame:
    """(id, source, size, source_size, target, copies, taken): one row per document, how often the mix takes it and how many words that is."""
    size = F.coalesce(F.regexp_count(F.col(text).cast("string"), F.lit(WORD)).cast("long"), F.lit(0).cast("long"))
    rows = docs.select(F.col(id).alias("id"), F.col(source).cast("string").alias("source"), size.alias("size"))
    items = stored(rows.groupBy("source", "id", "size").agg(F.count("*").alias("rows")))
    sums = items.groupBy("source").agg(F.sum(F.col("size") * F.col("rows")).alias("source_size"), F.sum("rows").alias("docs"))
    sources = stored(targets(stored(sums), weights, most))
    bounds = sources.agg(F.max("docs").alias("docs"), F.count("*").alias("sources")).first()
    table = sources.select(F.col("source").alias("s"), "source_size", "docs", "target")
    table = F.broadcast(table) if bounds["sources"] <= SOURCE_ROWS else table
    rate = F.coalesce(F.try_divide(F.col("target"), F.col("source_size")), F.lit(0.0))
    rated = items.join(table, F.col("source").eqNullSafe(F.col("s"))).drop("s").withColumn("rate", F.least(rate, F.lit(float(most))))
    rated = rated.withColumn("base", F.floor("rate")).withColumn("share", (F.col("rate") - F.col("base")) * F.col("rows"))
    rated = rated.withColumn("sure", F.floor("share")).withColumn("p", F.col("share") - F.col("sure"))
    rated = stored(rated.drop("rate", "share"))
    open_ = (F.col("p") > 0) & (F.col("size") > 0)
    carried = F.struct("id", "size", "p", "rows", "base", "sure", "source_size", "target")
    rounded = round_copies(rated.filter(open_).select("source", "docs", carried.alias("item")), bounds["docs"] or 0, seed)
    columns = ["id", "size", "rows", "base", "sure", "source_size", "target"]
    decided = rounded.select("source", "one", *[f"item.{c}" for c in columns])
    decided = decided.unionByName(rated.filter(~open_).select("source", F.lit(0).cast("long").alias("one"), *columns))
    blocks = F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("rows") - 1) / EXPAND)))
    spread = decided.withColumn("__block", blocks)
    first = F.col("__block") * EXPAND + 1
    spread = spread.withColumn("__row", F.explode(F.sequence(first, F.least(F.col("rows"), first + EXPAND - 1))))
    copies = F.col("base") + F.when(F.col("__row") <= F.col("sure") + F.col("one"), 1).otherwise(0)
    out = spread.withColumn("copies", copies.cast("long"))
    return out.select(F.col("id").alias(id), F.col("source").alias(source), "size", "source_size", "target", "copies", (F.col("copies") * F.col("size")).alias("taken"))
