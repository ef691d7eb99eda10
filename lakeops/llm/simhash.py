"""SimHash near-dedup with the general pigeonhole principle.

A text's fingerprint: words (runs other than space and 0x09-0x0D) of the text with A-Z lower-cased, shingles of ``SHINGLE`` words joined by a space (a shorter
text is one shingle, an empty one has fingerprint zero), XXH64 with seed 42 of each shingle, repeats included; a bit is set if it is set in over half the
hashes.  Fingerprints link at ``RADIUS`` or fewer differing bits; a component is everything reachable by links.

Links are found among the different fingerprints, never by comparing all of them:

1. Bits are grouped into parts, correlated bits together (from the 64 x 64 counts of common ones over all fingerprints).
2. Two fingerprints within RADIUS differ in at most t(i) bits of some part i if the thresholds t add up to RADIUS - parts + 1, where -1 leaves a part out.
   Dynamic programming picks the thresholds, part by part, and the number of parts, that cost least: probes sent plus candidates expected, estimated
   from the measured collisions of each part's values and, for larger radii, from how often its bits differ.
3. Every fingerprint is indexed by its value in each used part and probes all values within t(i); candidates are verified by counting bits.
4. Values that more than ``HOT`` fingerprints share are not paired.  All fingerprints that probe such a value are linked exactly in another way: two words differ
   in at most two bits if and only if some word is within one bit of both.  Each sends itself to the 65 words within one bit; whoever
   meets at a word is linked in a star.  At most 65 can meet, so no group grows with the data.

Null text: no words.  Null ids: such a document takes part, but does not name a component (null if no member has an id).
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations
from math import comb

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakeops.llm.components import components
from lakeops.llm.scratch import stored

SHINGLE, SEED = 3, 42
RADIUS = 2  # of links; crowded values are linked by words within one bit, which stand for this radius
HOT = 48
BITS = 64
LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))
CANDIDATE_COST = 0.5  # of a probe sent


def shingle_hashes(text: str | None, size: int = SHINGLE) -> np.ndarray:
    words = (text or "").encode("utf-8", "replace").translate(LOWER).split()
    if not words:
        return np.zeros(0, np.uint64)
    size = min(size, len(words))
    joined = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    digest = xxhash.xxh64_intdigest
    spans = zip(starts[: len(words) - size + 1].tolist(), ends[size - 1 :].tolist(), strict=True)
    return np.array([digest(joined[a:b], SEED) for a, b in spans], np.uint64)


def fingerprint(text: str | None, size: int = SHINGLE) -> int:
    hashes = shingle_hashes(text, size)
    if not len(hashes):
        return 0
    ones = np.zeros(BITS, np.int64)
    for k in range(0, len(hashes), 1 << 16):
        bits = np.unpackbits(hashes[k : k + (1 << 16)].astype(">u8").view(np.uint8).reshape(-1, 8), axis=1)
        ones += bits.sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > len(hashes)).tobytes(), "big")


def fingerprints(docs: DataFrame, id: str, text: str, size: int = SHINGLE) -> DataFrame:
    """(id, fp): fp is the fingerprint's 64 bits as a signed long."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for start in range(0, whole.num_rows, 256):
                batch = whole.slice(start, 256)
                found = np.array([fingerprint(t, size) for t in batch.column(1).to_pylist()], np.uint64)
                yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found.view(np.int64))], ["id", "fp"])

    rows = docs.select(F.col(id).alias("id"), F.col(text).cast("string").alias("text"))
    return rows.mapInArrow(run, f"id {rows.schema['id'].dataType.simpleString()}, fp long")


def as_hex(fp: Column) -> Column:
    return F.lower(F.lpad(F.hex(fp), 16, "0"))


# How fingerprints are cut into parts


def common_ones(fps: DataFrame) -> tuple[int, np.ndarray]:
    """Number of fingerprints, and for each pair of bits in how many both are set."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((BITS, BITS), np.int64)
        n = 0
        for batch in batches:
            values = batch.column(0).to_numpy().view(np.uint64)
            for k in range(0, len(values), 1 << 14):
                bits = bits_of(values[k : k + (1 << 14)]).astype(np.float32)
                total += (bits.T @ bits).astype(np.int64)
                n += len(bits)
        at = np.arange(BITS * BITS + 1, dtype=np.int32)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(np.append(total.ravel(), n))], ["at", "n"])

    rows = fps.select("fp").mapInArrow(run, "at int, n long").groupBy("at").agg(F.sum("n").alias("n")).collect()  # 4097 rows
    flat = np.zeros(BITS * BITS + 1, np.int64)
    for row in rows:
        flat[row["at"]] = row["n"]
    return int(flat[-1]), flat[:-1].reshape(BITS, BITS)


def bits_of(values: np.ndarray) -> np.ndarray:
    """A row of 64 bits per value; column b is bit b (of weight 2**b)."""
    return np.unpackbits(values.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")


def group_bits(n: int, ones: np.ndarray, parts: int) -> list[list[int]]:
    """Parts of nearly equal width; each starts with the most correlated bits left and takes in the bit most correlated with it."""
    share = ones / max(1, n)
    p = np.diag(share)
    deviation = np.sqrt(np.maximum(p * (1 - p), 1e-9))
    related = np.abs(share - np.outer(p, p)) / np.outer(deviation, deviation)
    np.fill_diagonal(related, 0)
    left = set(range(BITS))
    out = []
    for k in range(parts):
        width = BITS // parts + (k < BITS % parts)
        pair = max(combinations(sorted(left), 2), key=lambda ij: (related[ij], -ij[0], -ij[1]))
        part = list(pair)
        left -= set(pair)
        while len(part) < width:
            best = max(sorted(left), key=lambda b: related[b, part].sum())
            part.append(best)
            left.remove(best)
        out.append(sorted(part))
    return out


def part_value(fp: Column, part: list[int]) -> Column:
    """The bits of a part, with all others zero."""
    mask = sum(1 << b for b in part)
    return fp.bitwiseAND(F.lit(mask - (1 << 64) if mask >= 1 << 63 else mask).cast("long"))


def within(differ: np.ndarray, radius: int) -> float:
    """Probability that at most ``radius`` of independent bits differ."""
    chance = np.zeros(radius + 1)
    chance[0] = 1
    for d in differ:
        chance[1:] = chance[1:] * (1 - d) + chance[:-1] * d
        chance[0] *= 1 - d
    return float(chance.sum())


def allocate(costs: list[list[float]], units: int) -> tuple[float, list[int]]:
    """Least total cost and the threshold of each part, where a threshold of t takes t + 1 of the units: ``costs[i][u]`` for u units in part i."""
    best: dict[int, tuple[float, list[int]]] = {0: (0.0, [])}
    for cost in costs:
        step: dict[int, tuple[float, list[int]]] = {}
        for used, (sum_, chosen) in best.items():
            for u in range(min(len(cost) - 1, units - used) + 1):
                option = (sum_ + cost[u], [*chosen, u - 1])
                if used + u not in step or option < step[used + u]:
                    step[used + u] = option
        best = step
    return best[units]


def plan_parts(fps: DataFrame, radius: int = RADIUS) -> list[tuple[list[int], int]]:
    """The used parts with their thresholds."""
    n, ones = common_ones(fps)
    differ = 2 * np.diag(ones) / max(1, n) * (1 - np.diag(ones) / max(1, n))
    options = []
    for parts in (2, 3, 4):
        groups = group_bits(n, ones, parts)
        values = F.explode(F.array(*[F.struct(F.lit(k).alias("part"), part_value(F.col("fp"), g).alias("v")) for k, g in enumerate(groups)]))
        shared = fps.select(values.alias("x")).groupBy("x.part", "x.v").agg(F.count("*").cast("double").alias("n"))
        found = {row["part"]: row["x"] for row in shared.groupBy("part").agg(F.sum(F.col("n") * (F.col("n") - 1)).alias("x")).collect()}
        measured = [found.get(k, 0.0) for k in range(parts)]
        costs = []
        for part, pairs in zip(groups, measured, strict=True):
            exact = max(pairs / max(1, n), n * within(differ[part], 0))  # candidates per fingerprint
            cost = [0.0]
            for t in range(radius + 1):
                growth = within(differ[part], t) / max(within(differ[part], 0), 1e-300)
                cost.append(sum(comb(len(part), k) for k in range(t + 1)) + CANDIDATE_COST * min(float(n), exact * growth))
            costs.append(cost)
        total, thresholds = allocate(costs, radius + 1)
        options.append((total, parts, [(g, t) for g, t in zip(groups, thresholds, strict=True) if t >= 0]))
    return min(options, key=lambda o: o[:2])[2]


def probes(fp: Column, part: list[int], threshold: int) -> Column:
    """All values within ``threshold`` bits of the fingerprint's value in the part."""
    flips = [sum(1 << b for b in chosen) for k in range(threshold + 1) for chosen in combinations(part, k)]
    signed = [f - (1 << 64) if f >= 1 << 63 else f for f in flips]
    value = part_value(fp, part)
    return F.transform(F.array(*[F.lit(f).cast("long") for f in signed]), lambda f: value.bitwiseXOR(f))


def links(fps: DataFrame, hot: int = HOT, plan: list[tuple[list[int], int]] | None = None) -> DataFrame:
    """Edges (a, b) that connect all fingerprints within ``RADIUS`` bits, for different fingerprints (fp).

    A pair inside a group of many similar ones may be connected through a third fingerprint within the radius of both.
    """
    plan = plan_parts(fps) if plan is None else plan
    fp = F.col("fp")
    index, sent = None, None
    for k, (part, threshold) in enumerate(plan):
        entries = fps.select(F.lit(k).alias("part"), part_value(fp, part).alias("v"), "fp")
        asked = fps.select(F.lit(k).alias("part"), F.explode(probes(fp, part, threshold)).alias("v"), "fp")
        index = entries if index is None else index.unionAll(entries)
        sent = asked if sent is None else sent.unionAll(asked)
    shared = index.groupBy("part", "v").agg(F.count("*").alias("n"))
    crowded = stored(shared.filter(F.col("n") > hot).select("part", "v"))
    if crowded.isEmpty():
        dense = None
        cold = sent
    else:
        dense = sent.join(crowded, ["part", "v"], "left_semi").select("fp").distinct()
        cold = sent.join(crowded, ["part", "v"], "left_anti")
    other = index.select("part", "v", F.col("fp").alias("other"))
    pairs = cold.join(other, ["part", "v"]).filter((F.col("fp") != F.col("other")) & (F.bit_count(fp.bitwiseXOR(F.col("other"))) <= RADIUS))
    edges = pairs.select(F.greatest("fp", "other").alias("a"), F.least("fp", "other").alias("b")).distinct()
    if dense is None:
        return edges
    flips = [0, *(1 << b for b in range(BITS - 1)), -(1 << 63)]
    near = F.explode(F.transform(F.array(*[F.lit(f).cast("long") for f in flips]), lambda f: fp.bitwiseXOR(f)))
    met = dense.select(near.alias("word"), "fp").groupBy("word").agg(F.collect_list("fp").alias("all"))  # 65 at most
    star = met.filter(F.size("all") > 1).select(F.explode("all").alias("a"), F.array_min("all").alias("b")).filter("a <> b").distinct()
    return edges.unionByName(star)


def near_duplicates(docs: DataFrame, id: str = "doc_id", text: str = "text", size: int = SHINGLE, hot: int = HOT) -> DataFrame:
    """(id, fingerprint, component_id): component_id is the smallest id reachable over links, the document's own included."""
    marked = stored(fingerprints(docs, id, text, size), 1000)
    different = stored(marked.groupBy("fp").agg(F.min("id").alias("least")))
    roots = components(links(different.select("fp"), hot))
    rooted = stored(different.join(roots, different["fp"] == roots["node"], "left").select("fp", "least", F.coalesce("root", "fp").alias("root")))
    names = stored(rooted.groupBy("root").agg(F.min("least").alias("component_id")))
    named = stored(rooted.join(names, "root").select(F.col("fp").alias("__fp"), "component_id"))
    return marked.join(named, F.col("fp") == F.col("__fp")).select(F.col("id").alias(id), as_hex(F.col("fp")).alias("fingerprint"), "component_id")
