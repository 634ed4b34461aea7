"""Embedding whitening from variances alone (polarisation).

Entries become whole numbers, x = floor(64 c) + 1000000. With n vectors and the
sums S of each dimension, n x - S is a whole number, n times the centred value.
The exact sums of squares are added up for every dimension, and for the sum of
every two dimensions; half of what the variance of a sum has beyond the two
variances is their covariance. The matrix of whole numbers is divided by n^3 once,
each entry correctly rounded, and given to a symmetric eigensolver.

Three passes over the vectors, none of which shuffles a vector: sums, squares, and
the covariance of the whitened values, each as one row of partial sums for each
task and entry, added up by Spark. Only the sums come to the driver: their number
is that of pairs of dimensions, whatever the number of vectors.

Dropped are vectors that are null or empty, hold a null or an entry that is not
finite or does not fit (|64 c| of 2^52 or more), or have another length than the
most frequent one (the smaller of equally frequent ones). Repeated rows and null
or repeated ids stay, each for itself. A component whose eigenvalue is 0 to double
precision (vectors that are all equal, fewer vectors than dimensions) has no
whitened value (null), and such components do not count for the identity error,
which is null without any. ``explained`` is null if nothing varies. A deviation
beyond a long is null. Equal eigenvalues keep the solver's order. An empty table
gives an empty result; other columns are not looked at.
"""

from decimal import Decimal
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradeloom.llm.text import in_arrow

SCALE, SHIFT = 64, 1_000_000
#: Rows handled at once; their squares of 24-bit parts add up within 63 bits.
ROWS = 4096
PART = 24
SUMS = "size int, entry int, total decimal(38,0)"
OUT = (
    "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"
)


# --- vectors -------------------------------------------------------------------

def whole_numbers(batch: pa.RecordBatch, name: str = "vector"):
    """(row numbers, matrix of x) for each length among the usable vectors of a batch."""
    column = batch.column(batch.schema.get_field_index(name))
    values = column.flatten().cast(pa.float64())
    lengths = np.asarray(column.value_lengths().fill_null(0)).astype(np.int64)
    flat = np.asarray(values.fill_null(np.nan), np.float64)
    begin = np.cumsum(lengths) - lengths
    with np.errstate(invalid="ignore", over="ignore"):
        fits = np.abs(flat * SCALE) < 2.0**52
    bad = np.concatenate(([0], np.cumsum(~fits)))
    usable = (lengths > 0) & (bad[begin + lengths] == bad[begin])
    for size in np.unique(lengths[usable]).tolist():
        rows = np.flatnonzero(usable & (lengths == size))
        for at in range(0, len(rows), ROWS):
            some = rows[at : at + ROWS]
            picked = flat[begin[some][:, None] + np.arange(size)]
            yield some, np.floor(picked * SCALE).astype(np.int64) + SHIFT


def centred(x: np.ndarray, n: int, sums: list[int]) -> np.ndarray:
    """n x - S, as 64-bit numbers if they surely fit, else as Python's."""
    most = max(int(np.abs(x).max(initial=0)) * n, max(map(abs, sums), default=0))
    if most < 2**60:
        return x * n - np.array(sums, np.int64)
    return x.astype(object) * n - np.array(sums, object)


def square_sums(t: np.ndarray) -> list[int]:
    """Exact sum of squares of every column of at most ROWS rows."""
    if not len(t):
        return [0] * t.shape[1]
    if t.dtype == object:
        return [int(v) for v in (t * t).sum(0)]
    most = int(np.abs(t).max())
    if most * most * len(t) < 2**63:
        return np.einsum("ij,ij->j", t, t).tolist()
    if most < 2 ** (2 * PART):
        high, low = t >> PART, t & ((1 << PART) - 1)
        a, b, c = (np.einsum("ij,ij->j", p, q).tolist() for p, q in ((high, high), (high, low), (low, low)))
        return [(x << 2 * PART) + (y << PART + 1) + z for x, y, z in zip(a, b, c)]
    return square_sums(t.astype(object))


def _totals(parts: DataFrame) -> dict[int, dict[int, int]]:
    """Totals by vector length and entry: a row for each length and pair of dimensions."""
    found: dict = {}
    for row in parts.groupBy("size", "entry").agg(F.sum("total").alias("total")).collect():
        found.setdefault(row["size"], {})[row["entry"]] = int(row["total"])
    return found


def _rows_of(held: dict):
    for size, totals in held.items():
        for entry, total in enumerate(totals):
            yield size, entry, Decimal(total)


# --- passes ----------------------------------------------------------------------

def fit_sums(vectors: DataFrame) -> tuple[int, list[int]]:
    """n and S of the vectors of the most frequent length."""

    def rows(batches):
        held: dict = {}
        for batch in batches:
            for _, x in whole_numbers(batch):
                have = held.setdefault(x.shape[1], [0] * (x.shape[1] + 1))
                # |x| is below 2^53: parts of it add up within 63 bits
                high, low = (x >> PART).sum(0).tolist(), (x & ((1 << PART) - 1)).sum(0).tolist()
                for k, (a, b) in enumerate(zip(high, low)):
                    have[k] += (a << PART) + b
                have[-1] += len(x)
        yield from _rows_of(held)

    found = _totals(in_arrow(vectors.select("vector"), rows, SUMS))
    if not found:
        return 0, []
    size = min(found, key=lambda s: (-found[s][s], s))
    return found[size][size], [found[size][k] for k in range(size)]


def covariance_sums(vectors: DataFrame, n: int, sums: list[int]) -> list[list[int]]:
    """The covariances times n^3, from the squares of dimensions and of sums of two."""
    size = len(sums)
    first = [size + i * size - i * (i + 1) // 2 - i - 1 for i in range(size)]  # entry of (i, j) is first[i] + j

    def rows(batches):
        total = [0] * (size + size * (size - 1) // 2)
        for batch in batches:
            for _, x in whole_numbers(batch):
                if x.shape[1] != size:
                    continue
                t = centred(x, n, sums)
                found = square_sums(t)
                for i in range(size - 1):
                    found += square_sums(t[:, i + 1 :] + t[:, i : i + 1])
                total = [a + b for a, b in zip(total, found)]
        yield from _rows_of({size: total})

    found = _totals(in_arrow(vectors.select("vector"), rows, SUMS))[size]
    squares = [[found[i] if i == j else 0 for j in range(size)] for i in range(size)]
    for i in range(size):
        for j in range(i + 1, size):
            # (u + v)^2 = u^2 + v^2 + 2 u v, so this is even
            squares[i][j] = squares[j][i] = (found[first[i] + j] - found[i] - found[j]) // 2
    return squares


class Whitening:
    """Mean, components by falling eigenvalue, and what they explain."""

    def __init__(self, n: int, sums: list[int], squares: list[list[int]], limit: int):
        self.n, self.sums = n, sums
        matrix = np.array([[float(Fraction(v, n**3)) for v in row] for row in squares])
        values, vectors = np.linalg.eigh(matrix)
        values, vectors = values[::-1], vectors[:, ::-1]
        self.count = min(limit, len(sums))
        trace = float(Fraction(sum(squares[k][k] for k in range(len(sums))), n**3))
        least = len(sums) * np.finfo(float).eps * max(values[0], 0.0)
        values = values[: self.count]
        self.varies = values > least
        self.explained = [max(float(v), 0.0) / trace if trace else None for v in values]
        self.axes = vectors[:, : self.count] / np.sqrt(np.where(self.varies, values, 1.0))

    def project(self, t: np.ndarray) -> np.ndarray:
        """Whitened values of rows n x - S; the division by n comes after the exact difference."""
        return (t.astype(np.float64) / self.n) @ self.axes


def identity_error(vectors: DataFrame, fit: Whitening) -> float | None:
    """Largest entry of the whitened values' covariance minus the identity."""
    k, size = fit.count, len(fit.sums)

    def rows(batches):
        mean, outer = np.zeros(k), np.zeros((k, k))
        for batch in batches:
            for _, x in whole_numbers(batch):
                if x.shape[1] == size:
                    w = fit.project(centred(x, fit.n, fit.sums))
                    mean, outer = mean + w.sum(0), outer + w.T @ w
        for entry, total in enumerate(np.concatenate((mean, outer.ravel())).tolist()):
            yield entry, total

    parts = in_arrow(vectors.select("vector"), rows, "entry int, total double")
    found = dict(parts.groupBy("entry").agg(F.sum("total")).collect())
    flat = np.array([found[e] for e in range(k + k * k)]) / fit.n
    mean = flat[:k]
    # The values are centred by S / n already; what rounding leaves is taken off again.
    off = flat[k:].reshape(k, k) - np.outer(mean, mean) - np.eye(k)
    off = off[np.ix_(fit.varies, fit.varies)]
    return float(np.abs(off).max()) if off.size else None


def whiten(embeddings: DataFrame, column: str = "embedding", limit: int = 32) -> DataFrame:
    """vec_id, component, n, deviation, whitened, explained, identity_error for each vector and component.

    The first ``limit`` components are returned.
    """
    quoted = "`" + column.replace("`", "``") + "`"
    rows = embeddings.select(F.col("vec_id").cast("long"), F.col(quoted).cast("array<double>").alias("vector"))
    n, sums = fit_sums(rows)
    if not n:
        return rows.sparkSession.createDataFrame([], OUT)
    fit = Whitening(n, sums, covariance_sums(rows, n, sums), limit)
    error = identity_error(rows, fit)
    k, size, varies = fit.count, len(sums), fit.varies

    def table(ids: pa.Array, t: np.ndarray) -> pa.RecordBatch:
        w = np.where(varies, fit.project(t), np.nan).ravel()
        m = len(t)
        each = lambda values, kind: pa.array(np.tile(np.array(values, dtype=kind), m))
        most = int(np.abs(t).max())
        if most * most * size < 2**63:
            away = np.einsum("ij,ij->i", t.astype(np.int64), t.astype(np.int64)).tolist()
        else:
            away = (t.astype(object) ** 2).sum(1).tolist()
        away = pa.array([v if v < 2**63 else None for v in away], pa.int64())
        index = pa.array(np.repeat(np.arange(m), k))
        explained = pa.array(fit.explained * m, pa.float64())
        whitened = pa.array(w, pa.float64(), mask=np.isnan(w))
        columns = [
            ids.take(index), each(np.arange(1, k + 1), np.int32), each([n] * k, np.int64), away.take(index),
            whitened, explained, pa.array([error] * (m * k), pa.float64()),
        ]
        return pa.RecordBatch.from_arrays(columns, names=[c.split()[0] for c in OUT.split(", ")])

    def run(batches):
        for batch in batches:
            for some, x in whole_numbers(batch):
                if x.shape[1] == size:
                    yield table(batch.column(0).take(pa.array(some)), centred(x, n, sums))

    return rows.mapInArrow(run, OUT)

