"""Quality rules: counts per text, and the perplexity of a character n-gram model with bands per language.

The model is an interpolated, modified Kneser-Ney model of order ``ORDER`` per language.  Characters are folded to 12-bit classes
(lower case, all digits one class, all white space one class, characters from U+0800 on share classes by remainder), so an n-gram
is one 60-bit key and its suffix and context are bit operations on that key.  Spark counts the n-grams of all texts and derives
every probability with joins and aggregates; the model is stored as keys in sorted order with their log probabilities.

Scoring looks keys up in sorted arrays.  Spark sorts the model by range, and each range is written as segments of keys and values in a file of the shared folder; only a row per
segment (its first key and place) reaches the driver and the tasks, whatever the model's size.  A task sorts its texts' different n-grams and walks
them through the segments they fall into, mapped into memory; on a file system that cannot map files, segments are read whole and the last ones kept within ``CACHE_BYTES``.

A text is rejected by the method if its log perplexity leaves ``[median - LOWER * spread, median + UPPER * spread]`` of its language,
with spread = 1.4826 times the median absolute deviation, over all texts that pass the base rules; shorter texts scatter more, so the spread grows
by ``sqrt(1 + SHORT / characters)``.  Languages with fewer than ``MIN_TEXTS`` such texts have no band.
LOWER and UPPER were fitted on the labels of sf0.1: of a grid of quarters, the bands that reject most texts labelled bad and at most 1 % of those labelled good.

Null text: no words, base rules fail.  Null language: a language of its own, named "".  Repeated rows are scored one by one.  Columns to keep that are named like an added one are
left out.
"""

from __future__ import annotations

import uuid
from collections import OrderedDict
from collections.abc import Callable, Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType
from pyspark.sql.window import Window

from lakeops.llm.scratch import new_folder, opened, stored
from lakeops.llm.words import Chunk, repeated, row_ranges, windows

ORDER = 5
BITS = 12
SEGMENT_ROWS = 1 << 20  # model rows of a range, about
CACHE_BYTES = 256 << 20
BATCH_ROWS = 1000
LANGUAGES = 10_000  # a broadcast table of bands or discounts has at most so many rows
LOWER, UPPER, SHORT, MIN_TEXTS = 3.75, 2.75, 400.0, 50
START = 1  # class of the padding before a text
SYMBOLS = np.zeros(256, bool)
SYMBOLS[list(b"#*$%&|<>")] = True


def _fold_table() -> np.ndarray:
    table = np.arange(0x0800, dtype=np.uint64)
    for c in range(0x0800):
        low = chr(c).lower()
        table[c] = 0x20 if chr(c).isspace() else 0x30 if chr(c).isdigit() else ord(low) if len(low) == 1 and ord(low) < 0x0800 else c
    table[0:2] = 2
    return table


def folded(chars: np.ndarray) -> np.ndarray:
    """The class of each code point."""
    if not _fold:
        _fold.append(_fold_table())
    return np.where(chars < 0x0800, _fold[0][np.minimum(chars, 0x07FF)], (0x0800 + chars % 2039).astype(np.uint64))


_fold: list[np.ndarray] = []


def ngram_keys(texts: pa.Array, order: int) -> tuple[np.ndarray, np.ndarray]:
    """The key of the n-gram that ends at each character (padded at a text's start), and characters per text."""
    chunk = Chunk(texts)
    chars = np.frombuffer(chunk.data.tobytes().decode("utf-8", "replace").encode("utf-32-le"), np.uint32)
    lengths = chunk.count_bytes((chunk.data & 0xC0) != 0x80)
    pad = order - 1
    at = np.arange(len(chars)) + pad * np.repeat(np.arange(1, len(lengths) + 1), lengths)
    padded = np.full(len(chars) + pad * len(lengths), START, np.uint64)
    padded[at] = folded(chars)
    keys = np.zeros(len(padded), np.uint64)
    for k in range(order):
        keys[k:] |= padded[: len(padded) - k] << np.uint64(BITS * k)
    return keys[at], lengths


def _summed(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    order = np.argsort(keys, kind="stable")
    keys, counts = keys[order], counts[order]
    first = np.flatnonzero(np.append(True, keys[1:] != keys[:-1])) if len(keys) else np.zeros(0, np.int64)
    return keys[first], np.add.reduceat(counts, first) if len(keys) else counts


def _by_language(batch: pa.RecordBatch, lang: str) -> Iterator[tuple[str, np.ndarray]]:
    """Each language of the batch with its row numbers."""
    codes = batch.column(lang).cast(pa.large_string()).fill_null("").dictionary_encode()
    index = codes.indices.to_numpy()
    for k, name in enumerate(codes.dictionary.to_pylist()):
        yield name, np.flatnonzero(index == k)


def _count(order: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[str, list[tuple[np.ndarray, np.ndarray]]] = {}
        for batch in batches:
            for name, rows in _by_language(batch, "lang"):
                texts = batch.column("text").take(pa.array(rows))
                parts = found.setdefault(name, [])
                for start, stop in row_ranges(texts):
                    keys = np.sort(ngram_keys(texts[start:stop], order)[0])
                    first = np.flatnonzero(np.append(True, keys[1:] != keys[:-1])) if len(keys) else np.zeros(0, np.int64)
                    parts.append((keys[first], np.diff(np.append(first, len(keys)))))
                    if len(parts) >= 8:
                        parts[:] = [_summed(*map(np.concatenate, zip(*parts, strict=True)))]
        for name, parts in found.items():
            keys, counts = _summed(*map(np.concatenate, zip(*parts, strict=True)))
            for k in range(0, len(keys), 100_000):
                part = keys[k : k + 100_000].astype(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([name] * len(part), pa.string()), pa.array(part), pa.array(counts[k : k + 100_000].astype(np.int64))],
                    ["lang", "key", "n"],
                )

    return run


def count_ngrams(docs: DataFrame, order: int = ORDER) -> DataFrame:
    """(lang, key, n) over all texts.  Tasks count their own texts first, so a row is shuffled per task and distinct n-gram."""
    counts = docs.select(F.col("lang").cast("string").alias("lang"), F.col("text").cast("string").alias("text"))
    return counts.mapInArrow(_count(order), "lang string, key long, n long").groupBy("lang", "key").agg(F.sum("n").alias("n"))


def _discounts(table: DataFrame) -> DataFrame:
    """Modified Kneser-Ney discounts d1, d2, d3 per language and length from the counts of counts; 0.5, 1 and 1.5 where these are too few."""
    of = lambda k: F.sum(F.when(F.col("n") == k, 1).otherwise(0))
    sums = table.groupBy("lang", "length").agg(*[of(k).alias(f"t{k}") for k in range(1, 5)])
    y = F.col("t1") / (F.col("t1") + 2 * F.col("t2"))
    formula = lambda k: k - (k + 1) * y * F.col(f"t{k + 1}") / F.col(f"t{k}")
    usable = (F.col("t1") > 0) & (F.col("t2") > 0) & (F.col("t3") > 0)
    at = lambda k: F.when(usable, F.greatest(F.lit(0.0), F.least(F.lit(float(k)), F.try_divide(formula(k), F.lit(1))))).otherwise(k / 2)
    return sums.select("lang", "length", *[at(k).alias(f"d{k}") for k in (1, 2, 3)])


def kneser_ney(counts: DataFrame, order: int = ORDER) -> DataFrame:
    """(lang, length, key, logp, logb) of all n-grams up to ``order``; logb is the back-off weight of the key as a context, or null.

    The longest n-grams have their counts; shorter ones the number of different characters before them.  Discounts, contexts and
    each n-gram's own share are formed for all lengths at once; only the back-off goes from length to length.
    """
    tables = {order: counts}
    for k in range(order - 1, 0, -1):
        tables[k] = stored(tables[k + 1].groupBy("lang", F.col("key").bitwiseAND((1 << BITS * k) - 1).alias("key")).agg(F.count("*").alias("n")))
    rows = reduce(DataFrame.unionByName, [table.withColumn("length", F.lit(k)) for k, table in tables.items()])
    rows = rows.withColumn("context", F.shiftright("key", BITS))
    discounts = stored(_discounts(rows))
    discounts = F.broadcast(discounts) if discounts.count() <= LANGUAGES else discounts
    on = ["lang", "length", "context"]
    kind = lambda test: F.sum(F.when(test, 1).otherwise(0))
    gamma = (F.col("d1") * F.col("n1") + F.col("d2") * F.col("n2") + F.col("d3") * F.col("n3")) / F.col("total")
    contexts = (
        rows.groupBy(*on)
        .agg(F.sum("n").alias("total"), kind(F.col("n") == 1).alias("n1"), kind(F.col("n") == 2).alias("n2"), kind(F.col("n") > 2).alias("n3"))
        .join(discounts, ["lang", "length"])
    )
    contexts = stored(contexts.select(*on, "total", "d1", "d2", "d3", gamma.alias("gamma")))
    used = F.when(F.col("n") == 1, F.col("d1")).when(F.col("n") == 2, F.col("d2")).otherwise(F.col("d3"))
    share = ((F.col("n") - used) / F.col("total")).alias("share")
    own = stored(rows.join(contexts, on).select("lang", "length", "key", share, "gamma"))
    lower = tables[1].groupBy("lang").agg((1.0 / (F.count("*") + 1)).alias("lower")).withColumn("suffix", F.lit(0).cast("long"))
    out: list[DataFrame] = []
    for k in range(1, order + 1):
        level = own.filter(F.col("length") == k).withColumn("suffix", F.col("key").bitwiseAND((1 << BITS * (k - 1)) - 1))
        p = F.col("share") + F.col("gamma") * F.col("lower")
        scored = stored(level.join(lower, ["lang", "suffix"]).select("lang", "length", "key", p.alias("p")))
        out.append(scored.select("lang", "length", "key", F.log("p").alias("logp")))
        lower = scored.select("lang", F.col("key").alias("suffix"), F.col("p").alias("lower"))
    weight = F.log(F.greatest(F.lit(1e-12), "gamma")).alias("logb")
    weights = contexts.select("lang", (F.col("length") - 1).alias("length"), F.col("context").alias("key"), weight)
    return reduce(DataFrame.unionByName, out).join(weights, ["lang", "length", "key"], "full")


Segment = tuple[str, int, str, int, int, str, int]  # language, length, kind, first key, rows, file, offset of its keys; the values follow them
KINDS = ("logp", "logb")


def write_model(model: DataFrame, folder: str, segment_rows: int = SEGMENT_ROWS) -> list[Segment]:
    """Writes the model as sorted arrays and returns the segments: a row for each range, language, length and kind."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, base = opened(folder)
        held: dict[tuple[str, int], list[pa.RecordBatch]] = {}
        for batch in batches:  # a range has about segment_rows
            if not batch.num_rows:
                continue
            place = batch.column("lang").dictionary_encode()
            codes = place.indices.to_numpy() * 64 + batch.column("length").to_numpy()
            cuts = np.flatnonzero(np.append(True, codes[1:] != codes[:-1]))
            for at, end in zip(cuts.tolist(), [*cuts[1:].tolist(), len(codes)], strict=True):
                part = batch.slice(at, end - at)
                held.setdefault((part.column("lang")[0].as_py(), part.column("length")[0].as_py()), []).append(part)
        if not held:
            return
        name, at, rows = f"{base}/{uuid.uuid4().hex}.bin", 0, []
        with system.open_output_stream(name, compression=None) as stream:
            for (lang, length), parts in held.items():
                key = np.concatenate([p.column("key").to_numpy() for p in parts])
                for kind in KINDS:
                    value = np.concatenate([p.column(kind).cast("double").fill_null(np.nan).to_numpy(zero_copy_only=False) for p in parts])
                    there = ~np.isnan(value)
                    if there.any():
                        stream.write(key[there].astype("<u8").tobytes() + value[there].astype("<f8").tobytes())
                        rows.append((lang, length, kind, int(key[there][0]), int(there.sum()), name, at))
                        at += 16 * int(there.sum())
        yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*rows, strict=True)], [f.split()[0] for f in fields.split(", ")])

    fields = "lang string, length long, kind string, first long, n long, file string, at long"
    order = ["lang", "length", "key"]
    ranges = max(1, -(-model.count() // segment_rows))
    segments = model.repartitionByRange(ranges, *order).sortWithinPartitions(*order).mapInArrow(run, fields)
    return [tuple(r) for r in stored(segments).collect()]


class Model:
    """The arrays that ``write_model`` wrote, opened where they are needed."""

    def __init__(self, segments: list[Segment], folder: str, order: int):
        self.order, self.system = order, opened(folder)[0]
        self.mapped: dict[str, pa.Buffer] = {}
        self.cache: OrderedDict[tuple[str, int], tuple[np.ndarray, np.ndarray]] = OrderedDict()
        self.cached = 0
        self.of: dict[tuple[str, int, str], list[Segment]] = {}
        for s in sorted(segments, key=lambda s: s[3]):
            self.of.setdefault(s[:3], []).append(s)

    def _arrays(self, segment: Segment) -> tuple[np.ndarray, np.ndarray]:
        *_, n, name, at = segment
        if isinstance(self.system, fs.LocalFileSystem):
            if name not in self.mapped:
                self.mapped[name] = pa.memory_map(name).read_buffer()
            return np.frombuffer(self.mapped[name], "<u8", n, at), np.frombuffer(self.mapped[name], "<f8", n, at + 8 * n)
        if (name, at) not in self.cache:
            with self.system.open_input_file(name) as file:
                data = file.read_at(16 * n, at)
            self.cache[name, at] = np.frombuffer(data, "<u8", n), np.frombuffer(data, "<f8", n, 8 * n)
            self.cached += 16 * n
            while self.cached > CACHE_BYTES and len(self.cache) > 1:
                self.cached -= 16 * len(self.cache.popitem(last=False)[1][0])
        self.cache.move_to_end((name, at))
        return self.cache[name, at]

    def look_up(self, lang: str, length: int, kind: str, keys: np.ndarray) -> np.ndarray:
        """The values of sorted keys; NaN where there is none."""
        out, segments = np.full(len(keys), np.nan), self.of.get((lang, length, kind), [])
        cuts = np.searchsorted(keys, np.array([s[3] for s in segments], np.uint64))
        for segment, a, b in zip(segments, cuts, [*cuts[1:], len(keys)], strict=True):
            if a < b:
                table, values = self._arrays(segment)
                at = np.minimum(np.searchsorted(table, keys[a:b]), len(table) - 1)
                out[a:b] = np.where(table[at] == keys[a:b], values[at], np.nan)
        return out

    def _values(self, lang: str, length: int, kind: str, keys: np.ndarray) -> np.ndarray:
        different, place = np.unique(keys, return_inverse=True)
        return self.look_up(lang, length, kind, different)[place]

    def knows(self, lang: str) -> bool:
        return (lang, 1, "logp") in self.of

    def log_probabilities(self, lang: str, keys: np.ndarray) -> np.ndarray:
        """Per key the natural log of its last character's probability after the others; unseen n-grams back off to shorter ones."""
        different, place = np.unique(keys, return_inverse=True)
        out, left = np.zeros(len(different)), np.arange(len(different))
        for k in range(self.order, 0, -1):
            short = different[left] & np.uint64((1 << BITS * k) - 1)
            value = self._values(lang, k, "logp", short)
            seen = ~np.isnan(value)
            out[left[seen]] += value[seen]
            left, short = left[~seen], short[~seen]
            if not len(left):
                return out[place]
            weight = self._values(lang, k - 1, "logb", short >> np.uint64(BITS))
            out[left] += np.where(np.isnan(weight), 0.0, weight)
        out[left] -= np.log(sum(s[4] for s in self.of[lang, 1, "logp"]) + 1)
        return out[place]


def text_counts(chunk: Chunk) -> dict[str, np.ndarray]:
    """The base counts of each text of the chunk."""
    rows = chunk.word_rows
    n_words = chunk.per_row(rows)
    characters = chunk.in_word & ((chunk.data & 0xC0) != 0x80)
    starts, ends, line_rows = chunk.lines()
    keys, at = windows(chunk.hashes(chunk.starts, chunk.ends), rows, 5)
    twice = repeated(keys ^ (rows[at].astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93)))
    edge = np.zeros(len(rows) + 6, np.int64)
    np.add.at(edge, at[twice], 1)
    np.add.at(edge, at[twice] + 5, -1)
    covered = np.cumsum(edge)[: len(rows)] > 0
    return {
        "n_words": n_words,
        "word_chars": chunk.count_bytes(characters),
        "n_symbols": chunk.count_bytes(SYMBOLS[chunk.data]),
        "n_dup_lines": chunk.per_row(line_rows) - _distinct_per_row(chunk, starts, ends, line_rows),
        "n_repeat_words": chunk.per_row(rows[covered]),
    }


def _distinct_per_row(chunk: Chunk, starts: np.ndarray, ends: np.ndarray, rows: np.ndarray) -> np.ndarray:
    hashes = chunk.hashes(starts, ends)
    order = np.lexsort((hashes, rows))
    hashes, rows = hashes[order], rows[order]
    new = np.append(True, (hashes[1:] != hashes[:-1]) | (rows[1:] != rows[:-1]))[: len(rows)]
    return chunk.per_row(rows[new])


COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def _features(shared, folder: str, order: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Base counts, the sum of log probabilities and the number of characters; ``shared`` is a broadcast of the model's segments."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = Model(shared.value, folder, order)
        for batch in batches:
            texts = batch.column("__text")
            parts = [text_counts(Chunk(texts[a:b])) for a, b in row_ranges(texts)]
            columns = [pa.array(np.concatenate([p[c] for p in parts]) if parts else np.zeros(0, np.int64)) for c in COUNTS]
            total, chars = np.zeros(batch.num_rows), np.zeros(batch.num_rows, np.int64)
            for name, rows in _by_language(batch, "__lang"):
                if not model.knows(name):  # all its texts are empty
                    continue
                own = texts.take(pa.array(rows))
                for a, b in row_ranges(own):
                    keys, lengths = ngram_keys(own[a:b], order)
                    score = np.concatenate([[0.0], np.cumsum(model.log_probabilities(name, keys))])
                    stop = np.cumsum(lengths)
                    total[rows[a:b]], chars[rows[a:b]] = score[stop] - score[stop - lengths], lengths
            kept = [k for k, c in enumerate(batch.schema.names) if c != "__text"]
            names = [*(batch.schema.names[k] for k in kept), *COUNTS, "logp", "n_scored"]
            yield pa.RecordBatch.from_arrays([*(batch.column(k) for k in kept), *columns, pa.array(total), pa.array(chars)], names)

    return run


def bands(scored: DataFrame, min_texts: int = MIN_TEXTS) -> DataFrame:
    """(lang, middle, spread) of the column ``x`` (log perplexity): medians at a resolution of a thousandth.

    Texts are counted into bins at once; all else works on the bins, whose number does not grow with the texts.
    """
    bins = stored(scored.groupBy("lang", F.round("x", 3).alias("bin")).agg(F.count("*").alias("n")))

    def median(rows: DataFrame, value: str, name: str) -> DataFrame:
        counted = rows.groupBy("lang", F.col(value).alias("v")).agg(F.sum("n").alias("n"))
        up = F.sum("n").over(Window.partitionBy("lang").orderBy("v"))
        ordered = counted.withColumns({"up": up, "all": F.sum("n").over(Window.partitionBy("lang"))})
        return ordered.filter(2 * F.col("up") >= F.col("all")).groupBy("lang").agg(F.min("v").alias(name), F.max("all").alias("texts"))

    middle = stored(median(bins, "bin", "middle"))
    far = bins.join(middle.drop("texts"), "lang").withColumn("far", F.round(F.abs(F.col("bin") - F.col("middle")), 3))
    spread = stored(median(far, "far", "mad"))
    out = middle.join(spread.drop("texts"), "lang").filter(F.col("texts") >= min_texts)
    return out.select("lang", "middle", F.greatest(F.lit(0.01), 1.4826 * F.col("mad")).alias("spread"))


def base_failed() -> Column:
    return (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))


ADDED = (*COUNTS, "base_failed", "log_perplexity", "kept")


def quality_rules(
    docs: DataFrame, keep: list[str], order: int = ORDER, lower: float = LOWER, upper: float = UPPER, segment_rows: int = SEGMENT_ROWS
) -> DataFrame:
    """The columns ``keep`` of ``docs``, the base counts, ``base_failed``, ``log_perplexity`` (per character; null for empty texts) and ``kept``.

    ``docs`` needs the columns text and lang.
    """
    spark = docs.sparkSession
    keep = [k for k in keep if k.lower() not in ADDED]
    folder = new_folder(spark)
    segments = write_model(stored(kneser_ney(stored(count_ngrams(docs, order), BATCH_ROWS), order)), folder, segment_rows)
    shared = spark.sparkContext.broadcast(segments)
    kept = [F.col(k).alias(f"__k{n}") for n, k in enumerate(keep)]
    source = docs.select(*kept, F.coalesce(F.col("lang").cast("string"), F.lit("")).alias("__lang"), F.col("text").cast("string").alias("__text"))
    fields = StructType([f for f in source.schema if f.name != "__text"])
    for name, kind in [*((c, "long") for c in COUNTS), ("logp", "double"), ("n_scored", "long")]:
        fields = fields.add(name, kind)
    out = source.mapInArrow(_features(shared, folder, order), fields)
    x = F.when(F.col("n_scored") > 0, F.round(-F.col("logp") / F.col("n_scored"), 9))
    out = stored(out.withColumn("log_perplexity", x).withColumn("base_failed", base_failed()), BATCH_ROWS)
    shared.destroy()
    limits = bands(out.filter("NOT base_failed").select(F.col("__lang").alias("lang"), F.col("log_perplexity").alias("x")))
    limits = stored(limits.withColumnRenamed("lang", "__lang"))
    limits = F.broadcast(limits) if limits.count() <= LANGUAGES else limits
    wide = F.col("spread") * F.sqrt(1 + SHORT / F.greatest(F.lit(1), "n_scored"))
    low, high = F.col("middle") - lower * wide, F.col("middle") + upper * wide
    inside = F.col("middle").isNull() | F.col("log_perplexity").between(low, high)
    joined = out.join(limits, "__lang", "left").withColumn("kept", ~F.col("base_failed") & F.coalesce(inside, F.lit(True)))
    return joined.select(*[F.col(f"__k{n}").alias(k) for n, k in enumerate(keep)], *ADDED)
