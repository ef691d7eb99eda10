"""Words, lines and their 64-bit hashes for a chunk of texts at once, with numpy over the UTF-8 bytes that Arrow hands over.

A word is a run of bytes other than space and 0x09-0x0D (those bytes never occur inside a longer UTF-8 sequence).  A null text is
an empty text.  Chunks hold about a quarter of a megabyte of text, or one text if that is longer, so memory does not grow with the batch.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cached_property

import numpy as np
import pyarrow as pa

CHUNK_BYTES = 1 << 18
SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True
_BASE = 0x9E3779B97F4A7C15 | 1
_powers = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def _geometric(base: int, n: int) -> np.ndarray:
    out = np.ones(n, np.uint64)
    out[1:] = np.uint64(base)
    return np.cumprod(out, dtype=np.uint64)


def _power_tables(n: int) -> list[np.ndarray]:
    """Powers of the hash base and of its inverse modulo 2**64, at least n of them."""
    if len(_powers[0]) < n:
        n = max(n, CHUNK_BYTES + 1)
        _powers[:] = [_geometric(_BASE, n), _geometric(pow(_BASE, -1, 1 << 64), n)]
    return _powers


def mixed(h: np.ndarray) -> np.ndarray:
    """The finalizer of splitmix64: every input bit reaches every output bit."""
    h = h ^ (h >> np.uint64(30))
    h = h * np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(27)
    h *= np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets (one more than rows) of a string column; nulls are empty."""
    column = column.cast(pa.large_string()).fill_null("")
    if not len(column):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def row_ranges(column: pa.Array, limit: int = CHUNK_BYTES) -> Iterator[tuple[int, int]]:
    """Consecutive (start, stop) rows whose texts have at most ``limit`` bytes together, or one row."""
    _, offsets = buffers(column)
    start = 0
    while start < len(column):
        stop = max(start + 1, int(np.searchsorted(offsets, offsets[start] + limit, "right")) - 1)
        yield start, stop
        start = stop


class Chunk:
    """Some texts, laid end to end.  Positions are byte positions in ``data``."""

    def __init__(self, column: pa.Array):
        self.data, self.offsets = buffers(column)
        self.rows = len(column)

    @cached_property
    def in_word(self) -> np.ndarray:
        return ~SPACE[self.data]

    @cached_property
    def _word_bounds(self) -> tuple[np.ndarray, np.ndarray]:
        inside, edges = self.in_word, self.offsets[self.offsets < len(self.data)]
        before, after = np.zeros_like(inside), np.zeros_like(inside)
        before[1:], after[:-1] = inside[:-1], inside[1:]
        before[edges] = False
        after[edges[edges > 0] - 1] = False
        return np.flatnonzero(inside & ~before), np.flatnonzero(inside & ~after) + 1

    @property
    def starts(self) -> np.ndarray:
        return self._word_bounds[0]

    @property
    def ends(self) -> np.ndarray:
        return self._word_bounds[1]

    def row_of(self, positions: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.offsets, positions, "right") - 1

    @cached_property
    def word_rows(self) -> np.ndarray:
        return self.row_of(self.starts)

    def per_row(self, rows: np.ndarray, weights: np.ndarray | None = None) -> np.ndarray:
        return np.bincount(rows, weights, self.rows).astype(np.int64)

    def count_bytes(self, chosen: np.ndarray) -> np.ndarray:
        """Per row, how many positions are chosen (a Boolean for each byte)."""
        total = np.zeros(len(chosen) + 1, np.int64)
        np.cumsum(chosen, out=total[1:])
        return total[self.offsets[1:]] - total[self.offsets[:-1]]

    def hashes(self, starts: np.ndarray, ends: np.ndarray, data: np.ndarray | None = None) -> np.ndarray:
        """A 64-bit hash of each span: equal for equal bytes, wherever they stand."""
        if data is None:
            total = self._prefix
        else:
            total = self._prefix_of(data)
        return mixed((total[ends] - total[starts]) * _power_tables(len(self.data) + 1)[1][starts])

    def _prefix_of(self, data: np.ndarray) -> np.ndarray:
        power = _power_tables(len(data) + 1)[0]
        total = np.zeros(len(data) + 1, np.uint64)
        np.cumsum((data.astype(np.uint64) + np.uint64(1)) * power[: len(data)], out=total[1:])
        return total

    @cached_property
    def _prefix(self) -> np.ndarray:
        return self._prefix_of(self.data)

    def lines(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Starts, ends and rows of the \\n-split lines that hold a word."""
        breaks = np.flatnonzero(self.data == 0x0A)
        starts = np.concatenate([self.offsets[:-1], breaks + 1])
        rows = np.concatenate([np.arange(self.rows), self.row_of(breaks)])
        order = np.lexsort((starts, rows))
        starts, rows = starts[order], rows[order]
        last = np.append(rows[1:] != rows[:-1], True)
        ends = np.where(last, self.offsets[rows + 1], np.append(starts[1:], 0) - 1)
        filled = np.zeros(len(self.data) + 1, np.int64)
        np.cumsum(self.in_word, out=filled[1:])
        keep = filled[ends] > filled[starts]
        return starts[keep], ends[keep], rows[keep]


def windows(hashes: np.ndarray, rows: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Hash of each run of ``size`` consecutive words of one row, and the index of its first word."""
    n = len(hashes) - size + 1
    if n <= 0:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    total = np.zeros(n, np.uint64)
    for k in range(size):
        total = total * np.uint64(_BASE) + hashes[k : k + n]
    first = np.flatnonzero(rows[:n] == rows[size - 1 :])
    return mixed(total[first]), first


def repeated(keys: np.ndarray) -> np.ndarray:
    """Which keys occur more than once."""
    ordered = np.sort(keys)
    twice = np.unique(ordered[1:][ordered[1:] == ordered[:-1]])
    return np.isin(keys, twice) if len(twice) else np.zeros(len(keys), bool)
