"""Whitening of embeddings by spectrum slicing.

1. Entries become whole numbers x; one pass gives n and the sums S per dimension, a second the sums of products of the centred y = x - floor(S / n).  Both are exact
   and do not depend on how Spark cut the table: products are formed in blocks that double precision holds exactly, and added as decimals.
   What reaches the driver is one row per dimension, then one per pair of dimensions.
2. The covariance V follows in exact arithmetic, (n M - R R') / n^2 with M the products' and R the remainders' sums, and is rounded once.
3. Spectrum slicing: V - s I = L D L' with symmetric pivoting in blocks of one and two (Bunch-Kaufman) has as many positive pivots as V has eigenvalues above s.
   Bisection over such counts isolates each leading eigenvalue; Rayleigh quotient iteration from there converges cubically, and counts on both sides of
   what it found certify its number.  If it left its interval, bisection goes on and it starts again.  Eigenvalues closer than ``CLUSTER`` of the trace cannot be told
   apart: they are found together, by iterating on a block, and any orthogonal basis of theirs serves.
4. A third pass measures the covariance of the whitened rows, a fourth gives them out.

Rows whose vector is null, or holds null or non-finite entries, are dropped, and so are those whose length is not that of most rows (ties: the longest; no length: none).
Entries are taken to be at most 2^44 in size after scaling (larger ones become that), which keeps sums of 10^11 rows in 38 digits; deviations beyond a long are null.
Directions without spread (an eigenvalue within rounding of zero, or fewer rows than components) have no whitened value and no rows: there are as many components as V's
rank allows.  Null and repeated ids: every row counts and comes out.  An empty table gives no rows.  Columns to keep that are named like an added one are left out.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

COMPONENTS = 32
SCALE, SHIFT, LARGEST = 64, 1_000_000, 1 << 44
CLUSTER = 1e-11
EXACT = 1 << 53
ROWS = 4096


def scaled(vectors: np.ndarray) -> np.ndarray:
    """x of every entry, as long."""
    with np.errstate(over="ignore"):
        return np.clip(np.floor(SCALE * vectors.astype(np.float64)), -LARGEST, LARGEST).astype(np.int64) + SHIFT


def _blocks(column: pa.Array, dimension: int) -> Iterator[np.ndarray]:
    """x of a column of whole vectors of that length, some rows at a time."""
    rows = max(1, min(ROWS, (1 << 20) // max(1, dimension)))
    for start in range(0, len(column), rows):
        part = column[start : start + rows]
        yield scaled(part.flatten().to_numpy(zero_copy_only=False).reshape(len(part), dimension))


def _fitting(df: DataFrame, vector: str, keep: list[str]) -> tuple[DataFrame, int]:
    """The rows with whole vectors as (keep..., __vector), and the vectors' length."""
    kind = df.schema[vector].dataType.simpleString()
    kind = kind if kind == "array<float>" else "array<double>"
    whole = df.select(*keep, F.col(vector).cast(kind).alias("__vector"))
    for value in ("NaN", "Infinity", "-Infinity"):  # null, neither true nor false, if an entry is null
        whole = whole.filter(f"array_contains(__vector, {kind[6:-1]}('{value}')) = false")
    most = whole.groupBy(F.size("__vector").alias("d")).count().orderBy(F.desc("count"), F.desc("d")).first()
    dimension = most["d"] if most else 0
    return whole.filter(F.size("__vector") == dimension), dimension


def sums(rows: DataFrame, dimension: int) -> tuple[int, list[int]]:
    """Number of vectors and the sum of each dimension."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, total = 0, [0] * dimension
        for batch in batches:
            for x in _blocks(batch.column(0), dimension):
                n += len(x)
                total = [a + b for a, b in zip(total, x.sum(axis=0).tolist(), strict=True)]
        values = [Decimal(v) for v in [n, *total]]
        yield pa.RecordBatch.from_arrays([pa.array(range(-1, dimension), pa.int32()), pa.array(values, pa.decimal128(38, 0))], ["at", "s"])

    found = rows.select("__vector").mapInArrow(run, "at int, s decimal(38,0)").groupBy("at").agg(F.sum("s").alias("s")).collect()  # dimension + 1 rows
    of = {r["at"]: int(r["s"]) for r in found}
    return of.get(-1, 0), [of.get(k, 0) for k in range(dimension)]


def _products(y: np.ndarray) -> np.ndarray:
    """The sums of products y' y as exact Python or machine numbers."""
    if len(y) * int(np.abs(y).max(initial=0)) ** 2 < EXACT:
        y = y.astype(np.float64)
        return (y.T @ y).astype(np.int64)
    y = y.astype(object)
    return y.T @ y


def products(rows: DataFrame, dimension: int, centre: list[int]) -> list[list[int]]:
    """The sums of products of the vectors less ``centre``, of each pair of dimensions."""
    upper = np.triu_indices(dimension)
    middle = np.array(centre, np.int64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, held, size = np.zeros(len(upper[0]), object), np.zeros(len(upper[0]), np.int64), 0
        for batch in batches:
            for x in _blocks(batch.column(0), dimension):
                block = _products(x - middle)[upper]
                if block.dtype == object or size > 500:
                    total, held, size = total + held, np.zeros_like(held), 0
                if block.dtype == object:
                    total = total + block
                else:
                    held, size = held + block, size + 1  # each below 2^53
        values = [Decimal(v) for v in (total + held).tolist()]
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(values))), pa.array(values, pa.decimal128(38, 0))], ["at", "s"])

    found = rows.select("__vector").mapInArrow(run, "at long, s decimal(38,0)").groupBy("at").agg(F.sum("s").alias("s")).toArrow()
    out = [[0] * dimension for _ in range(dimension)]
    for at, s in zip(found.column("at").to_pylist(), found.column("s").to_pylist(), strict=True):
        i, j = int(upper[0][at]), int(upper[1][at])
        out[i][j] = out[j][i] = int(s)
    return out


# Eigenvalues of a symmetric matrix


def pivots(matrix: np.ndarray) -> list[np.ndarray]:
    """The blocks of D in a factorisation L D L' of a symmetric matrix, by Bunch-Kaufman pivoting."""
    a, blocks, k, ratio = matrix.copy(), [], 0, (1 + 17**0.5) / 8
    n = len(a)

    def swap(i: int, j: int) -> None:
        if i != j:
            a[[i, j]] = a[[j, i]]
            a[:, [i, j]] = a[:, [j, i]]

    while k < n:
        size = 1
        column = np.abs(a[k + 1 :, k])
        most = column.max(initial=0.0)
        if most > 0 and abs(a[k, k]) < ratio * most:
            r = k + 1 + int(column.argmax())
            row = np.abs(a[k:, r])
            row[r - k] = 0
            other = row.max()
            if abs(a[k, k]) * other < ratio * most * most:
                if abs(a[r, r]) >= ratio * other:
                    swap(k, r)
                else:
                    size = 2
                    swap(k + 1, r)
        block = a[k : k + size, k : k + size].copy()
        blocks.append(block)
        rest = a[k + size :, k : k + size]
        if size == 2:
            a[k + 2 :, k + 2 :] -= rest @ np.linalg.solve(block, rest.T)
        elif block[0, 0] != 0:
            a[k + 1 :, k + 1 :] -= np.outer(rest, rest / block[0, 0])
        k += size
    return blocks


def above(matrix: np.ndarray, shift: float) -> int:
    """How many eigenvalues are larger than ``shift``: the positive part of the inertia of the shifted matrix."""
    shifted = matrix - shift * np.eye(len(matrix))
    count = 0
    for block in pivots(shifted):
        if len(block) == 1:
            count += block[0, 0] > 0
        else:
            det = block[0, 0] * block[1, 1] - block[0, 1] * block[1, 0]
            count += 1 if det < 0 else 2 * (block[0, 0] + block[1, 1] > 0)
    return int(count)


def _ritz(matrix: np.ndarray, basis: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues, falling, and vectors within the span of an orthonormal basis."""
    values, turned = np.linalg.eigh(basis.T @ matrix @ basis)
    return values[::-1], basis @ turned[:, ::-1]


def _solve(matrix: np.ndarray, right: np.ndarray) -> np.ndarray:
    try:
        return np.linalg.solve(matrix, right)
    except np.linalg.LinAlgError:  # the shift is an eigenvalue to the last bit
        return np.linalg.solve(matrix + np.finfo(float).eps * max(np.abs(matrix).max(), 1e-300) * np.eye(len(matrix)), right)


def _rayleigh(matrix: np.ndarray, start: float, known: np.ndarray) -> tuple[float, np.ndarray]:
    """An eigenpair near ``start``, orthogonal to the vectors known."""
    n = len(matrix)
    v = np.cos(np.arange(1, n + 1) ** 2.0)
    shift, scale = start, np.abs(matrix).sum(axis=1).max()
    for step in range(60):
        v = v - known @ (known.T @ v)
        v /= np.linalg.norm(v)
        rest = matrix @ v - shift * v if step > 2 else None
        if rest is not None and np.linalg.norm(rest) <= 4 * np.finfo(float).eps * scale:
            break
        v = _solve(matrix - shift * np.eye(n), v)
        v -= known @ (known.T @ v)
        v /= np.linalg.norm(v)
        if step >= 2:  # the first steps stay at the interval's middle, so that the iteration settles on its eigenvalue
            shift = float(v @ matrix @ v)
    return float(v @ matrix @ v), v


def leading(matrix: np.ndarray, wanted: int) -> tuple[np.ndarray, np.ndarray]:
    """The ``wanted`` largest eigenvalues, falling, that are above rounding, and their vectors as columns."""
    n = len(matrix)
    trace = float(np.trace(matrix)) if n else 0.0
    if not trace > 0:
        return np.zeros(0), np.zeros((n, 0))
    counts: dict[float, int] = {}

    def count(shift: float) -> int:
        if shift not in counts:
            counts[shift] = above(matrix, shift)
        return counts[shift]

    floor, ceiling = n * np.finfo(float).eps * trace, 1.0001 * trace
    wanted = min(wanted, n, count(floor))
    counts[ceiling] = 0
    values, vectors = np.zeros(0), np.zeros((n, 0))
    while len(values) < wanted:
        k = len(values) + 1  # the number sought: more than k - 1 eigenvalues lie above low, at most k - 1 above high
        low = max(s for s, c in counts.items() if c >= k)
        high = min(s for s, c in counts.items() if c < k)
        while True:
            if high - low <= CLUSTER * trace:  # several within rounding of each other
                size = counts[low] - len(values)
                block = np.cos(np.outer(np.arange(1, n + 1), np.arange(1, size + 1)) ** 1.5)
                for _ in range(6):
                    block -= vectors @ (vectors.T @ block)
                    block = np.linalg.qr(_solve(matrix - (low + high) / 2 * np.eye(n), np.linalg.qr(block)[0]))[0]
                block = np.linalg.qr(block - vectors @ (vectors.T @ block))[0]
                e, v = _ritz(matrix, block)
                break
            middle = (low + high) / 2
            if counts[low] == k and counts[high] == k - 1 and high - low < 0.25 * max(high, trace / n):
                e, v = _rayleigh(matrix, middle, vectors)
                margin = max(CLUSTER * trace / 4, 1e-12 * abs(e))
                if low - margin <= e <= high + margin and count(e - margin) == k and count(e + margin) == k - 1:
                    e, v = np.array([e]), v[:, None]
                    break
            if count(middle) >= k:
                low = middle
            else:
                high = middle
        values, vectors = np.append(values, e), np.hstack([vectors, v])
    return values[:wanted], vectors[:, :wanted]


# Whitening


class Fit:
    """What whitening needs of the table: n, S, and the leading eigenvalues and vectors of the covariance."""

    def __init__(self, rows: DataFrame, dimension: int, components: int):
        self.n, self.s = sums(rows, dimension)
        self.centre = [s // self.n if self.n else 0 for s in self.s]
        m = products(rows, dimension, self.centre) if self.n else []
        r = [s - self.n * c for s, c in zip(self.s, self.centre, strict=True)]
        over = self.n * self.n
        exact = [[(self.n * m[i][j] - r[i] * r[j]) / over for j in range(dimension)] for i in range(dimension)] if self.n else []
        self.covariance = np.array(exact, float).reshape(len(exact), len(exact))
        self.values, self.vectors = leading(self.covariance, components)
        self.explained = self.values / max(float(np.trace(self.covariance)), 1e-300)
        self.fraction = np.array([x / self.n for x in r]) if self.n else np.zeros(0)

    def projector(self) -> Callable[[np.ndarray], np.ndarray]:
        centre, fraction, turned = np.array(self.centre, np.int64), self.fraction, self.vectors / np.sqrt(self.values)
        return lambda x: ((x - centre) - fraction) @ turned


def _deviations(x: np.ndarray, n: int, s: list[int]) -> list[int | None]:
    """The sums of (n x - S)^2, exactly; None beyond a long."""
    largest = int(np.abs(x).max(initial=0)) * n + max(map(abs, s), default=0)
    if x.shape[1] * largest**2 >= 1 << 63:  # by the differences, which may be small all the same
        middle = [v // n for v in s]
        y, rest = x - np.array(middle, np.int64), [v - n * c for v, c in zip(s, middle, strict=True)]
        bound = int(np.abs(y).max(initial=0)) * n + n
        if x.shape[1] * bound**2 >= 1 << 63:
            totals = ((n * y.astype(object) - np.array(rest, object)) ** 2).sum(axis=1)
            return [t if t < 1 << 63 else None for t in totals.tolist()]
        return ((n * y - np.array(rest, np.int64)) ** 2).sum(axis=1).tolist()
    return ((n * x - np.array(s, np.int64)) ** 2).sum(axis=1).tolist()


def identity_error(rows: DataFrame, dimension: int, fit: Fit) -> float:
    """The largest absolute entry of the whitened rows' covariance less the identity."""
    project, k = fit.projector(), len(fit.values)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((k + 1, k))
        for batch in batches:
            for x in _blocks(batch.column(0), dimension):
                w = project(x)
                total += np.vstack([w.T @ w, w.sum(axis=0)])
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(total.size)), pa.array(total.ravel())], ["at", "s"])

    found = rows.select("__vector").mapInArrow(run, "at long, s double").groupBy("at").agg(F.sum("s").alias("s")).toArrow()  # components^2 rows
    total = np.zeros(((k + 1) * k))
    total[found.column("at").to_numpy()] = found.column("s").to_numpy()
    total = total.reshape(k + 1, k) / fit.n
    return float(np.abs(total[:k] - np.outer(total[k], total[k]) - np.eye(k)).max())


def whiten(df: DataFrame, vector: str = "embedding", keep: list[str] | None = None, components: int = COMPONENTS) -> DataFrame:
    """The columns ``keep`` with component, n, deviation, whitened, explained and identity_error: a row per vector and component."""
    added = StructType.fromDDL("component int, n long, deviation long, whitened double, explained double, identity_error double")
    keep = [k for k in keep or [] if k.lower() not in {f.name for f in added}]
    rows, dimension = _fitting(df, vector, keep)
    schema = StructType([*df.select(*keep).schema.fields, *added.fields])
    fit = Fit(rows, dimension, components)
    k = len(fit.values)
    if not k:
        return df.sparkSession.createDataFrame([], schema)
    error = identity_error(rows, dimension, fit)
    project, n, s, explained = fit.projector(), fit.n, fit.s, fit.explained

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            start = 0
            for x in _blocks(batch.column(batch.num_columns - 1), dimension):
                m = len(x)
                of = pa.array(np.repeat(np.arange(start, start + m), k))
                columns = [
                    pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), m)),
                    pa.array(np.full(m * k, n)),
                    pa.array(_deviations(x, n, s), pa.int64()).take(pa.array(np.repeat(np.arange(m), k))),
                    pa.array(project(x).ravel()),
                    pa.array(np.tile(explained, m)),
                    pa.array(np.full(m * k, error)),
                ]
                yield pa.RecordBatch.from_arrays([*(batch.column(c).take(of) for c in range(len(keep))), *columns], schema.names)
                start += m

    return rows.mapInArrow(run, schema)
