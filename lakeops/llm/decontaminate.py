"""Benchmark decontamination by template canonicalisation.

Texts become template tokens: words without surrounding punctuation, lower-cased, where numbers, names and units are replaced by typed placeholders.

* number: starts with a digit (after an optional currency sign), or is a number word;
* unit: a unit word right after a number;
* name: capitalised but not all capitals, and not at the start of a line or sentence.

Every run of ``WINDOW`` tokens is a window (a text with fewer tokens is one window, which only a text of the same length matches).  A window with fewer than
``LITERALS`` literal words says too little as a template and is compared with its literal words.  Windows of documents and benchmark items are joined by
hash.  Each match lies on a diagonal (position in the document minus position in the item); on one diagonal, equal slot values of the item must stand against equal slot values of the
document (another number everywhere instead of 5 is a re-parameterised question, two different ones are not), else the windows that hold such a slot do not count, unless they are equal
word for word.  A document is contaminated by an item if at least ``SIMILARITY`` of the item's different windows are matched.

Equal items are one.  Whatever matches ``SIMILARITY`` of an item's n windows matches one of any n - ceil(n * ``SIMILARITY``) + 1 of them: documents and items meet by those of the
item's windows that fewest items share, so a stock opening of many questions makes no pairs; only the pairs found so are compared in full, and equal items are named last.

Only windows that may occur in the benchmark leave the tasks: a bit table of fixed size (``FILTER_BITS``) with the hashes of all benchmark windows, which never misses one,
goes to every task.  The join itself is exact and of any size; Spark broadcasts the benchmark's side only if it is small.

Null or wordless texts have no windows and are clean, an item without words matches nothing.  ``contaminated`` judges rows with equal ids together (null is an id), ``verdicts`` each
row by itself.  Repeated items are found each.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lakeops.llm.scratch import stored
from lakeops.llm.words import _BASE, Chunk, mixed, row_ranges

WINDOW, LITERALS, SIMILARITY = 5, 2, 0.8
FILTER_BITS = 1 << 24
BROADCAST_WINDOWS = 100_000  # benchmark windows of which a broadcast side may have so many

NUMBER, UNIT, NAME = (np.uint64(v) for v in (11, 13, 17))
NUMBER_WORDS = (
    "zero one two three four five six seven eight nine ten eleven twelve thirteen fourteen fifteen sixteen seventeen eighteen nineteen twenty thirty forty "
    "fifty sixty seventy eighty ninety hundred thousand million billion"
).split()
UNITS = (
    "% mm cm m km in inch inches ft foot feet yard yards mile miles mg g kg ton tons tonne tonnes lb lbs pound pounds oz ounce ounces ml l liter liters litre "
    "litres gallon gallons s sec second seconds min minute minutes h hr hour hours day days week weeks month months year years dollar dollars cent cents euro "
    "euros percent degree degrees mph kph km/h w kw v volt volts watt watts hz khz mhz ghz kb mb gb tb"
).split()

_byte = np.arange(256)
DIGIT = (_byte >= 0x30) & (_byte <= 0x39)
UPPER = (_byte >= 0x41) & (_byte <= 0x5A)
LOWER = (_byte >= 0x61) & (_byte <= 0x7A)
OUTER = (_byte < 0x80) & ~DIGIT & ~UPPER & ~LOWER  # punctuation that is cut off at both ends of a word
OUTER[ord("%")] = False
STOPS = np.isin(_byte, list(b".!?:;"))


def lowered(data: np.ndarray) -> np.ndarray:
    """The bytes with A-Z and the two-byte capitals U+00C0-U+00DE in lower case."""
    out = data.copy()
    out[UPPER[data]] += 0x20
    second = np.zeros(len(data), bool)
    second[1:] = data[:-1] == 0xC3
    second &= (data >= 0x80) & (data <= 0x9E) & (data != 0x97)
    out[second] += 0x20
    return out


def _hash_words(words: list[str]) -> np.ndarray:
    chunk = Chunk(pa.array(words))
    return np.sort(chunk.hashes(chunk.offsets[:-1], chunk.offsets[1:]))


def _sums(flags: np.ndarray) -> np.ndarray:
    out = np.zeros(len(flags) + 1, np.int64)
    np.cumsum(flags, out=out[1:])
    return out


class Templates:
    """Template tokens of the texts of a chunk: row, hash of the literal word, and the placeholder's code (0 for a literal)."""

    def __init__(self, texts: pa.Array, numbers: np.ndarray, units: np.ndarray):
        chunk = Chunk(texts)
        data = chunk.data
        starts, ends, rows = chunk.starts, chunk.ends, chunk.word_rows
        low = lowered(data)
        word_ends = ends
        if len(starts):
            inner = np.append(~OUTER[data], True)
            at = np.flatnonzero(inner)
            starts = at[np.searchsorted(at, starts)]
            last = np.flatnonzero(~OUTER[data])
            found = np.searchsorted(last, ends) - 1
            ends = np.where(found >= 0, last[np.maximum(found, 0)] + 1, 0) if len(last) else np.zeros_like(ends)
        keep = starts < ends
        opening = chunk.starts
        before_end = np.append(0, word_ends[:-1]) if len(word_ends) else word_ends
        breaks = _sums(data == 0x0A)
        first = np.append(True, rows[1:] != rows[:-1])[: len(rows)]
        new_sentence = first | (breaks[opening] > breaks[before_end]) | (STOPS[data[np.maximum(before_end - 1, 0)]] if len(data) else first)
        starts, ends, rows, new_sentence = starts[keep], ends[keep], rows[keep], new_sentence[keep]
        self.rows = rows
        self.literal = chunk.hashes(starts, ends, low)
        capital = np.zeros(len(starts), bool)
        digit = np.zeros(len(starts), bool)
        if len(starts):
            head = data[starts]
            after = data[np.minimum(starts + 1, len(data) - 1)]
            wide = (head == 0xC3) & (after >= 0x80) & (after <= 0x9E) & (after != 0x97)
            small = _sums(LOWER[data] | ((data >= 0x80) & (low == data) & (data != 0xC3)))
            capital = (UPPER[head] | wide) & (small[ends] - small[np.minimum(starts + 1, ends)] > 0)
            digit = DIGIT[head]
        number = digit | np.isin(self.literal, numbers)
        follows = np.append(False, number[:-1] & (rows[1:] == rows[:-1]))[: len(rows)]
        unit = follows & ~number & np.isin(self.literal, units)
        name = capital & ~new_sentence & ~number & ~unit
        self.code = np.where(number, NUMBER, np.where(unit, UNIT, np.where(name, NAME, np.uint64(0))))

    def windows(self, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Row, position in the row, key and slots (literal hashes, 0 for no slot) of each window."""
        n = len(self.rows)
        first_of_row = np.flatnonzero(np.append(True, self.rows[1:] != self.rows[:-1])[:n])
        lengths = np.diff(np.append(first_of_row, n))
        position = np.arange(n) - np.repeat(first_of_row, lengths)
        length = np.repeat(lengths, lengths)
        at = np.flatnonzero((position + size <= length) | ((position == 0) & (length < size)))
        width = np.minimum(length[at], size)
        token = np.where(self.code > 0, self.code, self.literal)
        by_template, by_literal, literals = (np.zeros(len(at), np.uint64) for _ in range(3))
        slots = np.zeros((len(at), size), np.uint64)
        for k in range(size):
            inside = k < width
            i = np.minimum(at + k, n - 1)
            by_template = by_template * np.uint64(_BASE) + np.where(inside, token[i], np.uint64(0))
            by_literal = by_literal * np.uint64(_BASE) + np.where(inside, self.literal[i], np.uint64(0))
            literals += inside & (self.code[i] == 0)
            slots[:, k] = np.where(inside & (self.code[i] > 0), self.literal[i], np.uint64(0))
        plain = literals < min(LITERALS, size)
        slots[plain] = 0
        key = mixed(np.where(plain, by_literal, by_template) ^ (width.astype(np.uint64) << np.uint64(3)) ^ plain)
        return self.rows[at], position[at], key, slots


def _windows(size: int, bits: int | None, filter_) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Windows of texts (id, text); with a filter (a broadcast of packed bits) only those whose hash is in it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        numbers, units = _hash_words(NUMBER_WORDS), _hash_words(UNITS)
        table = np.frombuffer(filter_.value, np.uint8) if filter_ is not None else None
        for batch in batches:
            for a, b in row_ranges(batch.column("text")):
                rows, position, key, slots = Templates(batch.column("text")[a:b], numbers, units).windows(size)
                if table is not None:
                    place = key & np.uint64(bits - 1)
                    hit = (table[place >> np.uint64(3)] >> (place & np.uint64(7)).astype(np.uint8)) & 1 > 0
                    rows, position, key, slots = rows[hit], position[hit], key[hit], slots[hit]
                if not len(rows):
                    continue
                slot_lists = pa.ListArray.from_arrays(pa.array(np.arange(len(rows) + 1, dtype=np.int32) * size), pa.array(slots.ravel().view(np.int64)))
                ids = batch.column("id").take(pa.array(rows + a))
                yield pa.RecordBatch.from_arrays([ids, pa.array(position), pa.array(key.view(np.int64)), slot_lists], ["id", "position", "key", "slots"])

    return run


def template_windows(texts: DataFrame, id: str, text: str, size: int = WINDOW, bits: int | None = None, filter_=None) -> DataFrame:
    """(id, position, key, slots) of the template windows of each text."""
    rows = texts.select(F.col(id).alias("id"), F.col(text).cast("string").alias("text"))
    kind = rows.schema["id"].dataType.simpleString()
    return rows.mapInArrow(_windows(size, bits, filter_), f"id {kind}, position long, key long, slots array<long>")


def _filter(windows: DataFrame, bits: int) -> bytes:
    """A bit table with the low bits of all keys set.  At most bits / 64 rows reach the driver."""
    place = F.col("key").bitwiseAND(bits - 1)
    words = windows.groupBy(F.shiftright(place, 6).alias("word")).agg(F.bit_or(F.expr(f"shiftleft(1L, CAST(key & 63 AS INT))")).alias("set")).collect()
    table = np.zeros(bits // 64, np.int64)
    for row in words:
        table[row["word"]] = row["set"]
    return table.astype("<i8").tobytes()


def contaminated(
    docs: DataFrame, benchmark: DataFrame, id: str = "doc_id", text: str = "text", item_id: str = "item_id", item_text: str = "text",
    size: int = WINDOW, similarity: float = SIMILARITY, bits: int = FILTER_BITS, broadcast_windows: int = BROADCAST_WINDOWS,
) -> DataFrame:
    """(id, item_id, share): the share of the item's windows found in the document, for all pairs with at least ``similarity``."""
    spark = docs.sparkSession
    rows = benchmark.select(F.xxhash64(item_text).alias("id"), F.col(item_text).cast("string").alias("text")).distinct()
    windows = stored(template_windows(rows, "id", "text", size).select(F.col("id").alias("group"), F.col("position").alias("at"), "key", F.col("slots").alias("item_slots")))
    different = windows.groupBy("group", "key").agg(F.lit(1).alias("one")).drop("one")
    sharing = different.groupBy("key").agg(F.count("*").alias("sharing"))
    in_group = Window.partitionBy("group")
    ranked = different.join(sharing, "key").select(
        "group", "key", F.row_number().over(in_group.orderBy("sharing", "key")).alias("rank"), F.count("*").over(in_group).alias("windows")
    )
    ranked = stored(ranked)
    rarest = ranked.filter(F.col("rank") <= F.col("windows") - F.ceil(F.col("windows") * similarity - 1e-9) + 1).select("key", "group")
    shared = spark.sparkContext.broadcast(_filter(windows, bits))
    found = stored(template_windows(docs, id, text, size, bits, shared), 1000)
    shared.destroy()
    small = windows.count() <= broadcast_windows
    side = lambda df: F.broadcast(df) if small else df
    pairs = found.select("id", "key").distinct().join(side(rarest), "key").select("id", "group").distinct()
    wanted = pairs.join(side(windows), "group").select(F.col("id").alias("d"), "group", "key", "at", "item_slots")
    slots = F.filter(F.arrays_zip("item_slots", "slots"), lambda x: x["item_slots"] != 0)
    met = wanted.join(found.withColumnRenamed("key", "found"), (F.col("key") == F.col("found")) & F.col("id").eqNullSafe(F.col("d")))
    matches = stored(met.select("id", "group", "key", (F.col("position") - F.col("at")).alias("diagonal"), slots.alias("slots")))
    on = ["id", "group", "diagonal"]
    # A slot value of the item stands against one value of the document on a diagonal, or the windows that hold it do not count.
    values = matches.filter(F.size("slots") > 0).select(*on, F.explode("slots").alias("slot"))
    values = values.groupBy(*on, "slot.item_slots").agg(F.min("slot.slots").alias("low"), F.max("slot.slots").alias("high"))
    broken = values.filter("low <> high").groupBy(*[F.col(c).alias(f"b_{c}") for c in on]).agg(F.collect_list("item_slots").alias("broken"))  # an item's slots at most
    judged = matches.join(broken, [F.col(c).eqNullSafe(F.col(f"b_{c}")) for c in on], "left")
    falls = "broken IS NOT NULL AND exists(slots, s -> array_contains(broken, s.item_slots)) AND NOT forall(slots, s -> s.item_slots = s.slots)"
    counts = judged.filter(f"NOT ({falls})").groupBy("id", "group", "key").agg(F.lit(1).alias("one")).groupBy("id", "group").agg(F.count("*").alias("matched"))
    share = F.col("matched") / F.col("windows")
    enough = counts.join(ranked.select("group", "windows").distinct(), "group").filter(share >= similarity).select("id", "group", share.alias("share"))
    named = benchmark.select(F.xxhash64(item_text).alias("group"), F.col(item_id).alias("item"))
    return enough.join(named, "group").select(F.col("id").alias(id), F.col("item").alias(item_id), "share")


def verdicts(docs: DataFrame, benchmark: DataFrame, keep: list[str], id: str = "doc_id", text: str = "text", item_id: str = "item_id", **options) -> DataFrame:
    """The columns ``keep`` of every document, ``contaminated`` and ``items`` (sorted distinct ids of the items found; empty for none)."""
    keyed = docs.select(*[F.col(k).alias(f"__{n}") for n, k in enumerate(keep)], F.xxhash64(id, text).alias("__row"), F.col(text).alias("__text"))
    pairs = stored(contaminated(keyed, benchmark, "__row", "__text", item_id, **options))
    found = pairs.groupBy(F.col("__row").alias("__found")).agg(F.array_sort(F.collect_set(item_id)).alias("__items"))  # at most the benchmark's items
    joined = keyed.join(found, F.col("__row") == F.col("__found"), "left")
    kind = found.schema["__items"].dataType.simpleString()
    items = F.coalesce("__items", F.expr(f"CAST(array() AS {kind})"))
    kept = [F.col(f"__{n}").alias(k) for n, k in enumerate(keep)]
    return joined.select(*kept, F.col("__items").isNotNull().alias("contaminated"), items.alias("items"))
