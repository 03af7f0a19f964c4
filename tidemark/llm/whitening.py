"""Whitening of embeddings with covariances recovered from variances alone.

By polarisation, cov(a, b) = (var(a + b) - var(a) - var(b)) / 2: the only statistic is the sum of
squares of a centred dimension, or of the centred sum of two. These sums are whole numbers. Entries
are integers x with sums S over n vectors; n * x - S is split into n * u + r, where u = x - m is
centred at the integer m next to the mean and r = n * m - S is what that leaves, so the tasks add up
squares of small numbers and the rest follows exactly:

    sum (n x - S)^2 = n^2 sum u^2 + 2 n r sum u + n r^2

The covariance matrix is exact up to one rounding per entry, and the driver decomposes it.

Distribution: three passes over the vectors (lengths and sums; squares of dimensions and pairs; the
covariance of the whitened vectors) without a shuffle of vectors; a task hands on one row per dimension
or pair. The driver holds matrices of the vectors' length only. Components without variance (at most
FLAT of the whole) can't be whitened and are left out.

Defined results: vectors that are null or empty or hold null or non-finite entries take no part, nor
do vectors of another length than most (the shorter, if equally many); repeated rows and null ids are
rows like others; an empty table, and one whose vectors are all alike, give no rows; other columns are
left out; entries whose integer passes 2^40 in size stop the run.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from decimal import Decimal
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import finite_vector, fixed_point, matrix

COMPONENTS = 32
SHIFT = 1_000_000
LARGEST = 1 << 40
FLAT = 1e-11  # share of the trace
_SMALL = 1 << 25  # squares of sums of two such, over a batch, fit 64 bits

_DECIMAL = pa.decimal128(38, 0)


@dataclass
class Fit:
    """What whitening needs: how many vectors, their sums, and the scaled eigenvectors."""

    n: int
    sums: list[int]
    values: np.ndarray  # eigenvalues, falling
    axes: np.ndarray  # dimensions by components; columns are unit eigenvectors
    trace: float

    @property
    def middle(self) -> list[int]:
        """The integer next to the mean of each dimension."""
        return [(2 * s + self.n) // (2 * self.n) for s in self.sums]


def integers(vectors: DataFrame) -> DataFrame:
    """vec_id and x of the vectors that take part: finite, and of the most common length."""
    finite = vectors.where(finite_vector("embedding") & (F.size("embedding") > 0))
    lengths = finite.groupBy(F.size("embedding").alias("length")).count()
    most = lengths.orderBy(F.desc("count"), "length").limit(1).collect()
    length = most[0]["length"] if most else 0
    # Entries beyond LARGEST stop the run; held there, adding to them can't pass a long.
    edge = F.lit(LARGEST)
    x = F.transform(
        fixed_point("embedding"), lambda v: F.greatest(F.least(v, edge), -edge) + F.lit(SHIFT)
    )
    return finite.where(F.size("embedding") == length).select("vec_id", x.alias("x"))


def _checked(b: pa.RecordBatch, m: np.ndarray) -> np.ndarray:
    x = matrix(b.column("x"))
    if np.abs(x - SHIFT).max() >= LARGEST:
        raise ValueError("an entry is too large for exact sums")
    return x - m


def _sums(rows: DataFrame) -> tuple[int, list[int]]:
    """The number of vectors and their exact sums; one row per dimension reaches the driver."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, total = 0, None
        for b in batches:
            if b.num_rows:
                x = _checked(b, np.int64(0))
                total = x.sum(axis=0) if total is None else total + x.sum(axis=0)
                n += b.num_rows
        if n:
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(range(len(total)), pa.int32()),
                    pa.array([n] * len(total), pa.int64()),
                    pa.array([Decimal(int(t)) for t in total], _DECIMAL),
                ],
                ["d", "n", "total"],
            )

    found = rows.select("x").mapInArrow(add, "d int, n long, total decimal(38,0)")
    totals = found.groupBy("d").agg(F.sum("n").alias("n"), F.sum("total").alias("total"))
    by_dimension = sorted(totals.collect())
    return (by_dimension[0]["n"] if by_dimension else 0), [int(t["total"]) for t in by_dimension]


def _squares(rows: DataFrame, middle: list[int]) -> dict[tuple[int, int], int]:
    """Sums of squares of u of each dimension (d, d) and of each sum of two (d, e), d < e."""
    m = np.array(middle, np.int64)
    dim = len(middle)

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((dim, dim), object)
        seen = False
        for b in batches:
            if not b.num_rows:
                continue
            seen = True
            u = _checked(b, m)
            for at in range(0, len(u), 2048):
                block = u[at : at + 2048]
                if np.abs(block).max() >= _SMALL:
                    block = block.astype(object)
                for d in range(dim):
                    pair = block[:, d : d + 1] + block[:, d:]
                    pair[:, 0] = block[:, d]
                    total[d, d:] += (pair * pair).sum(axis=0).astype(object)
        if seen:
            d, e = np.triu_indices(dim)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(d, pa.int32()),
                    pa.array(e, pa.int32()),
                    pa.array([Decimal(int(t)) for t in total[d, e]], _DECIMAL),
                ],
                ["d", "e", "total"],
            )

    found = rows.select("x").mapInArrow(add, "d int, e int, total decimal(38,0)")
    totals = found.groupBy("d", "e").agg(F.sum("total").alias("total")).collect()
    return {(t["d"], t["e"]): int(t["total"]) for t in totals}


def covariance(n: int, sums: list[int], middle: list[int], squares: dict) -> np.ndarray:
    """The covariance matrix from sums of squares, each entry rounded once."""
    dim = len(sums)
    left = [n * m - s for m, s in zip(middle, sums)]  # n * x - S = n * u + left, and sum u = -left

    def centred(d: int, e: int) -> int:
        """sum of squares of n * x - S, for one dimension or the sum of two; over n."""
        r = left[d] if d == e else left[d] + left[e]
        return n * squares[d, e] - r * r

    own = [centred(d, d) for d in range(dim)]
    v = np.zeros((dim, dim))
    for d in range(dim):
        v[d, d] = own[d] / n**2
        for e in range(d + 1, dim):
            v[d, e] = v[e, d] = (centred(d, e) - own[d] - own[e]) / (2 * n**2)
    return v


def fit(rows: DataFrame, components: int = COMPONENTS) -> Fit | None:
    """rows: what ``integers`` returns. None if there is no variance."""
    n, sums = _sums(rows)
    if not n:
        return None
    found = Fit(n, sums, np.zeros(0), np.zeros((len(sums), 0)), 0.0)
    v = covariance(n, sums, found.middle, _squares(rows, found.middle))
    values, axes = np.linalg.eigh(v)
    found.trace = float(np.trace(v))
    order = np.argsort(-values, kind="stable")[:components]
    order = order[values[order] > FLAT * found.trace]
    found.values, found.axes = values[order], axes[:, order]
    return found if len(order) else None


def _whitener(found: Fit):
    """Vectors to whitened components, with x - S / n from whole numbers."""
    rest = np.array([float(Fraction(s, found.n) - m) for s, m in zip(found.sums, found.middle)])
    scaled = found.axes / np.sqrt(found.values)
    return lambda u: (u - rest) @ scaled


def identity_error(rows: DataFrame, found: Fit) -> float:
    """The largest entry of the whitened vectors' covariance minus the identity."""
    m, white, k = np.array(found.middle, np.int64), _whitener(found), len(found.values)

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((k, k + 1))
        for b in batches:
            if b.num_rows:
                w = white(_checked(b, m))
                total += w.T @ np.hstack([w, np.ones((len(w), 1))])
        d, e = np.indices(total.shape)
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(d.ravel(), pa.int32()),
                pa.array(e.ravel(), pa.int32()),
                pa.array(total.ravel()),
            ],
            ["d", "e", "total"],
        )

    sums = rows.select("x").mapInArrow(add, "d int, e int, total double").groupBy("d", "e")
    total = np.zeros((k, k + 1))
    for row in sums.agg(F.sum("total").alias("total")).collect():  # components squared
        total[row["d"], row["e"]] = row["total"]
    # Means are zero up to rounding, so taking them away here loses nothing.
    mean = total[:, k] / found.n
    return float(np.abs(total[:, :k] / found.n - np.outer(mean, mean) - np.eye(k)).max())


def _deviations(u: np.ndarray, n: int, left: list[int]) -> list[int]:
    """sum over dimensions of (n * u + left)^2, exactly."""
    edge = max(int(np.abs(u).max()) * n + max(map(abs, left)), 1)
    if edge * edge * u.shape[1] < 1 << 62:
        y = u * n + np.array(left, np.int64)
        return (y * y).sum(axis=1).tolist()
    return [sum((n * a + b) ** 2 for a, b in zip(row, left)) for row in u.tolist()]


def whitened(vectors: DataFrame, components: int = COMPONENTS) -> DataFrame:
    """One row per vector and component.

    ``deviation`` is a decimal of 38 digits, as it grows with the square of the table; a value beyond
    them is null.
    """
    schema = (
        "vec_id long, component int, n long, deviation decimal(38,0), whitened double, "
        "explained double, identity_error double"
    )
    rows = integers(vectors)
    found = fit(rows, components)
    if found is None:
        return vectors.sparkSession.createDataFrame([], schema)
    error = identity_error(rows, found)
    n, k = found.n, len(found.values)
    left = [n * m - s for m, s in zip(found.middle, found.sums)]
    m, white = np.array(found.middle, np.int64), _whitener(found)
    explained = found.values / found.trace
    largest = 10**38

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if not b.num_rows:
                continue
            u = _checked(b, m)
            far = [Decimal(t) if t < largest else None for t in _deviations(u, n, left)]
            each = np.repeat(np.arange(len(u)), k)
            yield pa.RecordBatch.from_arrays(
                [
                    b.column("vec_id").take(pa.array(each)),
                    pa.array(np.tile(np.arange(1, k + 1), len(u)), pa.int32()),
                    pa.array(np.full(len(each), n), pa.int64()),
                    pa.array(far, _DECIMAL).take(pa.array(each)),
                    pa.array(white(u).ravel()),
                    pa.array(np.tile(explained, len(u))),
                    pa.array(np.full(len(each), error)),
                ],
                [c.split()[0] for c in schema.split(", ")],
            )

    return rows.mapInArrow(score, schema)
