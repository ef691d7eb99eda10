"""Quality score of a text by a convolutional network over its bytes, in numpy.

The network: every byte becomes a learned vector of ``VECTOR`` numbers; ``FILTERS`` learned filters of ``WIDTH`` bytes are applied every ``STEP`` bytes of the whole text and
rectified.  Chunks of ``CHUNK`` bytes that overlap by half cover the text; of each chunk the mean and the maximum of every filter, and how much it varies, enter ``HIDDEN``
learned units, rectified; the document's value of a unit is its maximum over all chunks.  A logistic unit combines them into one probability.

Learning: at most ``SAMPLE`` labelled documents of each class with at most ``SAMPLE_BYTES`` bytes each, those with the smallest hashes, reach one task (what is learned
from is bounded), where ``EPOCHS`` rounds of mini-batch gradient steps (Adam) fit the network; the classes weigh as much as each other, and the output is then
shifted to the classes' shares among all labelled rows, so that it is a probability.  Seeds are fixed and the sample does not depend on partitions: runs agree.
The network, some hundred kilobytes, comes back through the driver to the tasks that score.

Labels: one row per document is expected; equal ones count once, documents with contradicting labels and labels other than 0 and 1 are left out.  Without labels of
both classes the score is the smoothed share of class 1.  Null text: empty text.  Empty texts have one chunk of padding and a score like others.  Null ids: scored, not held
out, never learned from.  Repeated rows: each is scored alike.  Columns to keep that are named like an added one (held_out, score, predicted) are left out.
"""

from __future__ import annotations

import io
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from lakeops.llm.words import buffers, row_ranges

VECTOR, FILTERS, WIDTH, STEP, CHUNK, HIDDEN = 8, 48, 8, 4, 256, 48
SAMPLE, SAMPLE_BYTES, EPOCHS, BATCH_BYTES, RATE = 1536, 8192, 8, 1 << 16, 4e-3
LEAST_SCORE = 0.7
PAD = 256  # byte beyond a text's end
HALF = CHUNK // 2
PER_HALF = HALF // STEP


class Layout:
    """Some texts cut into half chunks, each text padded to whole ones, two at least."""

    def __init__(self, column: pa.Array):
        data, offsets = buffers(column)
        size = np.diff(offsets)
        self.halves = np.maximum(2, -(-size // HALF))
        self.first = np.append(0, np.cumsum(self.halves))
        self.bytes = np.full(self.first[-1] * HALF + STEP, PAD, np.int16)
        place = np.arange(len(data)) + np.repeat(self.first[:-1] * HALF - offsets[:-1], size)
        self.bytes[place] = data
        self.last = self.first[1:] * PER_HALF - 1  # the last filter place of each text: what follows belongs to the next one
        self.chunks = self.halves - 1  # a chunk is a half and the next
        self.opens = np.append(0, np.cumsum(self.chunks))
        self.left = np.arange(self.opens[-1]) + np.repeat(np.arange(len(size)), self.chunks)  # the chunk's first half


def initial(seed: int = 0) -> dict[str, np.ndarray]:
    r = np.random.default_rng(seed)

    def normal(*shape: int, over: int = 1) -> np.ndarray:
        return (r.normal(size=shape) / np.sqrt(over)).astype(np.float32)

    features = 3 * FILTERS
    return {
        "vectors": np.vstack([normal(PAD, VECTOR), np.zeros((1, VECTOR), np.float32)]),
        "filters": normal(WIDTH * VECTOR, FILTERS, over=WIDTH * VECTOR),
        "filter_bias": np.zeros(FILTERS, np.float32),
        "units": normal(features, HIDDEN, over=features // 2),
        "unit_bias": np.zeros(HIDDEN, np.float32),
        "out": normal(HIDDEN, over=HIDDEN),
        "out_bias": np.zeros(1, np.float32),
    }


def forward(net: dict[str, np.ndarray], layout: Layout, keep: dict | None = None) -> np.ndarray:
    """The logit of each text; ``keep`` takes what the gradient needs."""
    row = STEP * VECTOR
    x = net["vectors"][layout.bytes].reshape(-1, row)
    h = x[1:] @ net["filters"][row:]
    h[layout.last] = 0
    h += x[:-1] @ net["filters"][:row] + net["filter_bias"]
    np.maximum(h, 0, out=h)
    blocks = h.reshape(-1, PER_HALF, FILTERS)
    mean, square, top = blocks.mean(axis=1), np.einsum("bpf,bpf->bf", blocks, blocks) / PER_HALF, blocks.max(axis=1)
    a, b = layout.left, layout.left + 1
    m = (mean[a] + mean[b]) / 2
    spread = np.sqrt(np.maximum((square[a] + square[b]) / 2 - m * m, 0) + np.float32(1e-4))
    features = np.hstack([m, spread, np.maximum(top[a], top[b])])
    u = features @ net["units"] + net["unit_bias"]
    np.maximum(u, 0, out=u)
    best = np.maximum.reduceat(u, layout.opens[:-1], axis=0)
    if keep is not None:
        keep.update(x=x, h=h, m=m, spread=spread, features=features, u=u, best=best, top=top)
    return best @ net["out"] + net["out_bias"][0]


def gradient(net: dict[str, np.ndarray], layout: Layout, target: np.ndarray, weight: np.ndarray) -> dict[str, np.ndarray]:
    """Of the weighted logistic loss.  A maximum passes its gradient to one of the places that reach it."""
    k: dict[str, np.ndarray] = {}
    logit = forward(net, layout, k)
    delta = ((1 / (1 + np.exp(-logit)) - target) * weight / weight.sum()).astype(np.float32)
    g = {"out": k["best"].T @ delta, "out_bias": delta.sum(keepdims=True)}
    d_best = np.outer(delta, net["out"])
    of = np.repeat(np.arange(len(delta)), layout.chunks)
    chosen = (k["u"] == k["best"][of]) & (k["u"] > 0)
    seen = np.vstack([np.zeros((1, HIDDEN), np.int64), np.cumsum(chosen, axis=0)])
    chosen &= seen[1:] - seen[layout.opens[:-1]][of] == 1  # the first of equal chunks
    d_u = np.where(chosen, d_best[of], 0).astype(np.float32)
    g["units"], g["unit_bias"] = k["features"].T @ d_u, d_u.sum(axis=0)
    d_features = d_u @ net["units"].T
    d_m, d_spread, d_top = np.split(d_features, 3, axis=1)
    d_square = d_spread / (2 * k["spread"])  # of the mean square
    d_m = d_m - 2 * d_square * k["m"]
    a, b = layout.left, layout.left + 1
    halves = layout.first[-1]
    top, both = k["top"], [np.zeros((halves, FILTERS), np.float32) for _ in range(3)]
    upper = top[a] >= top[b]
    for half, share in ((a, upper), (b, ~upper)):  # each half occurs once in a and once in b
        both[0][half] += d_m / 2
        both[1][half] += d_square / 2
        both[2][half] += np.where(share, d_top, 0)
    blocks = k["h"].reshape(-1, PER_HALF, FILTERS)
    d_h = (both[0] / PER_HALF)[:, None, :] + blocks * (2 * both[1] / PER_HALF)[:, None, :]
    at = blocks.argmax(axis=1)
    np.put_along_axis(d_h, at[:, None, :], np.take_along_axis(d_h, at[:, None, :], 1) + both[2][:, None, :], 1)
    d_h = np.where(blocks > 0, d_h, 0).reshape(-1, FILTERS)
    x, row = k["x"], STEP * VECTOR
    d_x, first, g["filter_bias"] = np.zeros_like(x), x[:-1].T @ d_h, d_h.sum(axis=0)
    d_x[:-1] += d_h @ net["filters"][:row].T
    d_h[layout.last] = 0
    g["filters"] = np.vstack([first, x[1:].T @ d_h])
    d_x[1:] += d_h @ net["filters"][row:].T
    d_x = d_x.reshape(-1, VECTOR)
    g["vectors"] = np.column_stack([np.bincount(layout.bytes, d_x[:, c], PAD + 1) for c in range(VECTOR)]).astype(np.float32)
    g["vectors"][PAD] = 0
    return g


def fit(texts: list[str], good: np.ndarray, share: float, epochs: int = EPOCHS) -> dict[str, np.ndarray]:
    """The network learned from texts of both classes, with its output shifted to a share of ``share`` good ones."""
    net, r = initial(), np.random.default_rng(1)
    moments = {k: (np.zeros_like(v), np.zeros_like(v)) for k, v in net.items()}
    good = good.astype(np.float32)
    of_class = np.where(good > 0, 0.5 / max(1.0, good.sum()), 0.5 / max(1.0, (1 - good).sum())) * len(good)
    size = np.array([len(t.encode()) + WIDTH for t in texts])
    step = 0
    for epoch in range(epochs):
        order = r.permutation(len(texts))
        cuts = np.flatnonzero(np.diff(np.cumsum(size[order]) // BATCH_BYTES)) + 1
        for batch in np.split(order, cuts):
            step += 1
            g = gradient(net, Layout(pa.array([texts[k] for k in batch])), good[batch], of_class[batch])
            rate = RATE * min(1.0, step / 20) * (1.0 if epoch < epochs - 2 else 0.25)
            for k, v in g.items():
                first, second = moments[k]
                first += 0.1 * (v - first)
                second += 0.01 * (v * v - second)
                net[k] = net[k] - rate * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.99**step)) + 1e-8)
    net["out_bias"] = net["out_bias"] + np.float32(np.log(share / (1 - share)))
    return {k: v.astype(np.float32) for k, v in net.items()}


def labelled_sample(docs: DataFrame, labels: DataFrame, id: str, text: str, label: str, held_out: Column) -> tuple[DataFrame | None, float]:
    """Rows to learn from (__label, __at, __text), None without both classes, and the smoothed share of class 1 among the labelled ids that are not held out."""
    one = labels.select(F.col(id).alias("__id"), F.col(label).cast("int").alias("__label")).filter("__id IS NOT NULL AND __label IN (0, 1)")
    one = one.filter(~F.coalesce(held_out, F.lit(False))).groupBy("__id").agg(F.min("__label").alias("__label"), F.max("__label").alias("__other"))
    one = one.filter("__label = __other").drop("__other").withColumn("__at", F.xxhash64("__id"))
    counts = {r["__label"]: r["count"] for r in one.groupBy("__label").count().collect()}  # two rows
    share = (counts.get(1, 0) + 1) / (sum(counts.values()) + 2)
    if len(counts) < 2:
        return None, share
    some = [one.filter(F.col("__label") == c).orderBy("__at", "__id").limit(SAMPLE) for c in (0, 1)]
    chosen = F.broadcast(some[0].unionByName(some[1]))  # 2 * SAMPLE ids at most
    found = docs.select(F.col(id).alias("__id"), F.col(text).cast("string").alias("__text")).join(chosen, "__id")
    found = found.filter(F.coalesce(F.octet_length("__text"), F.lit(0)) <= SAMPLE_BYTES).distinct()
    parts = [found.filter(F.col("__label") == c).orderBy("__at", "__id", F.xxhash64("__text"), "__text").limit(SAMPLE) for c in (0, 1)]
    return parts[0].unionByName(parts[1]).select("__label", "__at", "__text"), share


def learned(sample: DataFrame, share: float) -> dict[str, np.ndarray] | None:
    """The network fitted in one task to a bounded sample; None if one class is missing."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = sorted((r for b in batches for r in zip(*(c.to_pylist() for c in b.columns), strict=True)), key=lambda r: (r[0], r[1], r[2] or ""))
        good = np.array([r[0] for r in rows])
        if 0 < good.sum() < len(good):
            file = io.BytesIO()
            np.savez(file, **fit([r[2] or "" for r in rows], good, share))
            yield pa.RecordBatch.from_arrays([pa.array([file.getvalue()])], ["net"])

    found = sample.coalesce(1).mapInArrow(run, "net binary").collect()
    return dict(np.load(io.BytesIO(bytes(found[0]["net"])))) if found else None


def scorer(net: dict[str, np.ndarray] | None, share: float) -> Callable[[pa.Array], np.ndarray]:
    if net is None:
        return lambda texts: np.full(len(texts), share)

    def score(texts: pa.Array) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(forward(net, Layout(texts)).astype(np.float64), -500, 500)))

    return score


def quality_scores(
    docs: DataFrame, labels: DataFrame, held_out: Callable[[Column], Column], keep: list[str], id: str = "doc_id", text: str = "text", label: str = "quality"
) -> DataFrame:
    """The columns ``keep`` with held_out, score and predicted; ``held_out`` of an id says which rows are not learned from."""
    added = StructType.fromDDL("held_out boolean, score double, predicted int")
    keep = [k for k in keep if k.lower() not in {f.name for f in added}]
    sample, share = labelled_sample(docs, labels, id, text, label, held_out(F.col("__id")))
    score = scorer(learned(sample, share) if sample is not None else None, share)
    schema = StructType([*docs.select(*keep).schema.fields, *added.fields])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = batch.column(batch.num_columns - 1)
            for a, b in row_ranges(column):
                found = score(column[a:b])
                columns = [batch.column(batch.num_columns - 2)[a:b], pa.array(found), pa.array((found >= LEAST_SCORE).astype(np.int32))]
                yield pa.RecordBatch.from_arrays([*(batch.column(k)[a:b] for k in range(len(keep))), *columns], schema.names)

    out = F.coalesce(held_out(F.col(id)), F.lit(False)).alias("__held_out")
    return docs.select(*keep, out, F.col(text).cast("string").alias("__text")).mapInArrow(run, schema)
