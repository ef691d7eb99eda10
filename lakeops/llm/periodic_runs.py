"""Runs of repeated words in a text, by a suffix automaton with link-cut access.

A run is a stretch of consecutive words with smallest period q (words q apart are equal) and a length of max(``LEAST``, 2 q) or more, which no neighbouring word
extends.  A word is dropped from the collapsed text if any run contains it after that run's first q words, so a run leaves its first period.

1. Islands: a run's words all lie in windows of ``WINDOW`` words that occur twice or more in the text, so runs are sought only in the stretches that such windows
   cover.  Windows are compared by 64-bit hashes; equal hashes of different windows make an island larger and change no run.
2. The island's suffix automaton is built; its suffix links form a tree in which the path from the state of a prefix to the root holds all its suffixes.
3. Word by word, a link-cut access recolours that path with the word's number.  The old path falls into segments of one colour; a segment with colour c and
   longest suffix of L words says that the longest common suffix of the prefixes ending at i and at c has L words, and that none of them occurred in between.
   With d = i - c <= L the last 2 d words are a square, and d is the smallest period.  L = d holds just where the run first has its square: there it starts.
4. The square is extended to the right while words d apart are equal; L = d says that nothing extends it to the left.

Accesses cost the logarithm of the island's length in the mean, whatever its repeats; states hold one transition in place and others in a table.

Null and empty texts: no words, no runs, an empty collapsed text.  Repeated rows: each gets its own result.  Columns to keep that are named like an added column
(``n_words``, ``runs``, ``collapsed``) are left out.
"""

from __future__ import annotations

import zlib
from array import array
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from lakeops.llm.words import Chunk, mixed, row_ranges, windows

LEAST = 12
WINDOW = LEAST // 2
COMPACT = 200_000  # words from which on an island's tables are arrays of machine numbers
Rearrange = Callable[[object, int], "np.ndarray | None"]


def suffix_automaton(words: list[int]) -> tuple:
    """Suffix links, longest lengths and the state of each prefix.  State 1 is the root, 0 none."""
    states = 2 * len(words) + 2
    table = (lambda: [0] * states) if len(words) < COMPACT else (lambda: array("q", bytes(8 * states)))
    link, length, word_of, target = table(), table(), table(), table()  # word_of, target: a state's first transition (words from 1)
    more: dict[int, dict[int, int]] = {}
    last, new = 1, 2
    prefixes = []
    for word in words:
        word += 1
        current = new
        new += 1
        length[current] = length[last] + 1
        p, q = last, 0
        while p:
            if word_of[p] == word:
                q = target[p]
                break
            if not word_of[p]:
                word_of[p], target[p] = word, current
            else:
                others = more.get(p)
                if others is None:
                    more[p] = {word: current}
                elif word in others:
                    q = others[word]
                    break
                else:
                    others[word] = current
            p = link[p]
        if not p:
            link[current] = 1
        elif length[p] + 1 == length[q]:
            link[current] = q
        else:
            clone = new
            new += 1
            length[clone], link[clone] = length[p] + 1, link[q]
            word_of[clone], target[clone] = word_of[q], target[q]
            if q in more:
                more[clone] = dict(more[q])
            while p:
                if word_of[p] == word:
                    if target[p] != q:
                        break
                    target[p] = clone
                elif more[p][word] == q:
                    more[p][word] = clone
                else:
                    break
                p = link[p]
            link[q] = link[current] = clone
        last = current
        prefixes.append(current)
    return link, length, prefixes


def squares(words: list[int]) -> Iterator[tuple[int, int]]:
    """(end, period) of the first square of every run, by recolouring paths of suffix links."""
    up, length, prefixes = suffix_automaton(words)
    left, right, colour = ([0] * len(up) for _ in range(3)) if isinstance(up, list) else (array("q", bytes(8 * len(up))) for _ in range(3))

    def rotate(x: int) -> None:
        p = up[x]
        g = up[p]
        if left[p] == x:
            b = right[x]
            left[p] = b
            right[x] = p
        else:
            b = left[x]
            right[p] = b
            left[x] = p
        if b:
            up[b] = p
        up[p] = x
        up[x] = g
        if g:
            if left[g] == p:
                left[g] = x
            elif right[g] == p:
                right[g] = x

    for at, state in enumerate(prefixes, 1):  # colours are word numbers from 1; 0 is none
        below, x = 0, state
        while x:
            top, p = x, up[x]
            while p and (left[p] == x or right[p] == x):  # splay: x becomes the root of its path's tree
                top, g = p, up[p]
                if g and (left[g] == p or right[g] == p):
                    top = g
                    rotate(p if (left[g] == p) == (left[p] == x) else x)
                rotate(x)
                p = up[x]
            old = colour[top]  # a path's colour stands at the root of its tree
            deeper = right[x]
            if deeper:
                colour[deeper] = old
            if old and length[x] == at - old:
                yield at - 1, at - old
            right[x] = below
            below, x = x, p
        colour[below] = at


def runs_of(words: list[int], least: int = LEAST) -> list[tuple[int, int, int]]:
    """(start, length, period) of every run, by start, then period."""
    found, n = [], len(words)
    for end, period in squares(words):
        start = end - 2 * period + 1
        end += 1
        while end < n and words[end] == words[end - period]:
            end += 1
        if end - start >= least:
            found.append((start, end - start, period))
    return sorted(found, key=lambda r: (r[0], r[2]))


def islands(hashes: np.ndarray, rows: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the stretches of one row that are covered by windows which the row repeats."""
    keys, first = windows(hashes, rows, size)
    keys = mixed(keys ^ mixed(rows[first].astype(np.uint64)))
    order = np.argsort(keys, kind="stable")
    equal = keys[order][1:] == keys[order][:-1]
    twice = first[order[np.append(equal, False) | np.append(False, equal)]] if len(keys) else first
    cover = np.zeros(len(hashes) + 1, np.int64)
    np.add.at(cover, twice, 1)
    np.add.at(cover, twice + size, -1)
    inside = np.cumsum(cover[:-1]) > 0
    starts = np.flatnonzero(inside & (np.append(True, ~inside[:-1]) | np.append(True, rows[1:] != rows[:-1]))) if len(rows) else twice
    ends = np.flatnonzero(inside & (np.append(~inside[1:], True) | np.append(rows[1:] != rows[:-1], True))) + 1 if len(rows) else twice
    return starts, ends


def planted_tail(id: object, n: int) -> np.ndarray | None:
    """The words to read of a text with ``n`` words: in a tenth of the texts, chosen by their id, a tail becomes periodic (ids: whole numbers; null: none)."""
    if id is None or not n:
        return None
    h = zlib.crc32(str(id).encode())
    g = h // 10
    if h % 10:
        return None
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    at = np.arange(n)
    return np.where(at < a, at, a + (at - a) % p)


def _chunk_results(ids: list, texts: pa.Array, least: int, rearrange: Rearrange | None) -> Iterator[tuple[int, list, bytes]]:
    """Per text the number of its words, its runs and its collapsed words."""
    chunk = Chunk(texts)
    data = chunk.data.tobytes()
    rows = chunk.word_rows
    hashes = chunk.hashes(chunk.starts, chunk.ends)
    opens = np.searchsorted(rows, np.arange(chunk.rows + 1))
    orders = {}
    for row, id in enumerate(ids) if rearrange else ():
        order = rearrange(id, int(opens[row + 1] - opens[row]))
        if order is not None:
            orders[row] = order
            hashes[opens[row] : opens[row + 1]] = hashes[opens[row] + order]
    starts, ends = islands(hashes, rows, least // 2)
    long = ends - starts >= least
    starts, ends = starts[long], ends[long]
    bounds = np.searchsorted(starts, opens)
    for row in range(chunk.rows):
        words = data[chunk.offsets[row] : chunk.offsets[row + 1]].split()
        if row in orders:
            words = [words[k] for k in orders[row].tolist()]
        runs = []
        for a, b in zip((starts[bounds[row] : bounds[row + 1]] - opens[row]).tolist(), (ends[bounds[row] : bounds[row + 1]] - opens[row]).tolist(), strict=True):
            numbers: dict[bytes, int] = {}
            runs += [(a + s, m, q) for s, m, q in runs_of([numbers.setdefault(w, len(numbers)) for w in words[a:b]], least)]
        n = len(words)
        if runs:
            dropped = np.zeros(n + 1, np.int64)
            for s, m, q in runs:
                dropped[s + q] += 1
                dropped[s + m] -= 1
            words = [w for w, gone in zip(words, (np.cumsum(dropped[:-1]) > 0).tolist(), strict=True) if not gone]
        yield n, runs, b" ".join(words)


def periodic_runs(
    df: DataFrame, text: str, keep: list[str], id: str | None = None, least: int = LEAST, rearrange: Rearrange | None = None
) -> DataFrame:
    """The columns ``keep`` with n_words, runs (array of start, length, period, by start, then period) and the collapsed text of every row.

    ``rearrange(id, n)`` may say which of a text's n words to read, in which order; ``id`` names the column it gets.
    """
    added = StructType.fromDDL("n_words long, runs array<struct<start: long, length: long, period: long>>, collapsed string")
    keep = [k for k in keep if k.lower() not in {f.name for f in added}]
    kept = df.select(*keep).schema.fields
    schema = StructType([*kept, *added.fields])
    rows = df.select(*keep, (F.col(id) if id else F.lit(None).cast("long")).alias("__id"), F.col(text).cast("string").alias("__text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        run_type = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))
        for batch in batches:
            ids, texts = batch.column(batch.num_columns - 2), batch.column(batch.num_columns - 1)
            for a, b in row_ranges(texts):
                results = list(_chunk_results(ids[a:b].to_pylist(), texts[a:b], least, rearrange))
                found = [[dict(zip(("start", "length", "period"), r, strict=True)) for r in runs] for _, runs, _ in results]
                columns = [pa.array([n for n, _, _ in results], pa.int64()), pa.array(found, run_type), pa.array([c for _, _, c in results]).cast(pa.string())]
                yield pa.RecordBatch.from_arrays([*(batch.column(k)[a:b] for k in range(len(kept))), *columns], schema.names)

    return rows.mapInArrow(run, schema)


def digests(found: DataFrame, keep: list[str]) -> DataFrame:
    """The columns ``keep`` with the number of runs, the longest one (ties: smallest start, then period) and digests of runs and collapsed text."""
    best = "array_max(transform(runs, r -> struct(r.length AS length, -r.start AS before, -r.period AS shorter)))"
    lines = "array_join(transform(runs, r -> concat(r.start, ',', r.length, ',', r.period, '\\n')), '')"
    named = found.withColumn("__best", F.expr(best))
    return named.select(
        *keep,
        F.size("runs").cast("long").alias("n_runs"),
        F.expr("-__best.before").alias("start"),
        F.expr("__best.length").alias("length"),
        F.expr("-__best.shorter").alias("period"),
        F.expr("1000 * __best.length div -__best.shorter").alias("exponent_milli"),
        F.sha2(F.expr(lines), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )
