"""Exact k-means on integer vectors with bounds that remember when they were made.

Every vector keeps the distance to its own centroid and, for each group of centroids, a lower bound
on the distance to all others of that group, each with the round in which it was measured. The
centroids of all rounds are kept; a bound of round s is loosened in round t by the norm of the whole
way a centroid has gone from s to t, which is never more than the sum of its single steps. Where the
loosened bounds don't prove that the nearest centroid is still the same, distances are measured again
in whole numbers, so that results, ties included, are those of a full search.

Distribution: state (the vector with its bounds) is a written table per round and is never shuffled.
A round hands every task the current centroids and how far each has gone since each round. Sums are
kept exactly; after the first round only vectors that changed their cluster are added and taken away,
each task handing on one row per cluster and dimension. The driver holds centroids only.

Defined results: vectors that are null, of another length, or with null or non-finite entries take no
part; ties go to the smaller number; of rows with one id each is a vector of its own, and among equal
hashes the smaller vector comes first; null ids come last as first centroids; with fewer vectors than
centroids each is one; an empty table gives no rows; entries whose integer passes 2^27 in size stop the
run, as their squared distances need not fit a long.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import finite_vector, fixed_point, matrix, stored

CENTROIDS = 16
ROUNDS = 3
DIMENSIONS = 64
GROUPS = 16  # bounds a vector keeps
LARGEST = 1 << 27
SAFE = 1e-12  # relative; far above the rounding of a square root or a sum of two

_STATE = (
    "vec_id long, x array<long>, cluster int, before int, own double, own_round int, "
    "lower array<double>, lower_round array<int>, distance long, scanned long"
)


class Bounds:
    """The state of some vectors, as arrays; advanced by one round at a time."""

    def __init__(self, x, cluster, own, own_round, lower, lower_round):
        self.x, self.cluster, self.before = x, cluster, cluster.copy()
        self.own, self.own_round = own, own_round
        self.lower, self.lower_round = lower, lower_round
        self.scanned = np.zeros(len(x), np.int64)  # distances measured in this round

    @classmethod
    def fresh(cls, x: np.ndarray, groups: int) -> "Bounds":
        """Nothing known: every vector is in no cluster, and every bound is useless."""
        n = len(x)
        return cls(
            x,
            np.full(n, -1, np.int32),
            np.full(n, np.inf),
            np.zeros(n, np.int32),
            np.full((n, groups), -np.inf),
            np.zeros((n, groups), np.int32),
        )

    def _exact(self, rows: np.ndarray, centers: np.ndarray) -> np.ndarray:
        x = self.x[rows]
        self.scanned[rows] += len(centers)
        return (x * x).sum(axis=1)[:, None] - 2 * (x @ centers.T) + (centers * centers).sum(axis=1)

    def advance(self, centers: np.ndarray, gone: np.ndarray) -> None:
        """Assign to the nearest of centers.

        gone[s, j]: the way of centroid j from round s to this one, the last row's.
        """
        now = len(gone) - 1
        groups = self.lower.shape[1]
        member = np.arange(len(centers)) % groups
        group_gone = np.stack(
            [gone[:, member == g].max(axis=1, initial=0.0) for g in range(groups)], axis=1
        )
        known = self.cluster >= 0
        own_gone = gone[self.own_round, np.maximum(self.cluster, 0)]
        upper = np.where(known, (self.own + own_gone) * (1 + SAFE), np.inf)
        loose = self.lower * (1 - SAFE) - group_gone[
            self.lower_round, np.arange(groups)
        ] * (1 + SAFE)
        doubtful = np.flatnonzero(upper >= loose.min(axis=1))

        # First the own centroid exactly; that alone often settles it.
        best = np.full(len(self.x), np.iinfo(np.int64).max)
        with_own = doubtful[known[doubtful]]
        if len(with_own):
            gap = self.x[with_own] - centers[self.cluster[with_own]]
            best[with_own] = (gap * gap).sum(axis=1)
            self.scanned[with_own] += 1
            upper[with_own] = np.sqrt(best[with_own].astype(float)) * (1 + SAFE)
        number = np.where(known, self.cluster, len(centers)).astype(np.int64)
        measured: list[tuple[int, np.ndarray, np.ndarray, np.ndarray]] = []
        for g in range(groups):
            inside = np.flatnonzero(member == g)
            rows = doubtful[upper[doubtful] >= loose[doubtful, g]]
            if not len(inside) or not len(rows):
                continue
            squares = self._exact(rows, centers[inside])
            measured.append((g, rows, inside, squares))
            at = squares.argmin(axis=1)  # the smallest number among equals
            least = squares[np.arange(len(rows)), at]
            better = (least < best[rows]) | ((least == best[rows]) & (inside[at] < number[rows]))
            best[rows] = np.where(better, least, best[rows])
            number[rows] = np.where(better, inside[at], number[rows])

        # A vector that leaves its centroid has it among the others from now on.
        left = with_own[number[with_own] != self.cluster[with_own]]
        if len(left):
            g = member[self.cluster[left]]
            self.lower[left, g] = np.minimum(loose[left, g], upper[left] * (1 - 2 * SAFE))
            self.lower_round[left, g] = now
        for g, rows, inside, squares in measured:
            others = np.where(inside == number[rows][:, None], np.inf, np.sqrt(squares.astype(float)))
            self.lower[rows, g] = others.min(axis=1)
            self.lower_round[rows, g] = now
        self.before = self.cluster
        self.cluster = self.cluster.copy()
        self.cluster[doubtful] = number[doubtful]
        self.own[doubtful] = np.sqrt(best[doubtful].astype(float))
        self.own_round[doubtful] = now

    def distances(self, centers: np.ndarray) -> np.ndarray:
        gap = self.x - centers[self.cluster]
        return (gap * gap).sum(axis=1)


def _lists(a: np.ndarray, kind: pa.DataType) -> pa.Array:
    ends = np.arange(0, a.size + 1, a.shape[1], dtype=np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(a.ravel(), kind))


def _advance(state: DataFrame, history: list[np.ndarray], groups: int) -> DataFrame:
    """State after a round; a table of ids and vectors alone is a fresh state."""
    centers = history[-1]
    gone = np.stack([np.sqrt(((centers - c) ** 2).sum(axis=1).astype(float)) for c in history])
    names = [c.split()[0] for c in _STATE.split(", ")]
    fresh = "cluster" not in state.columns

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if not b.num_rows:
                continue
            x = matrix(b.column("x"))
            if np.abs(x).max() >= LARGEST or x.min() == np.iinfo(np.int64).min:
                raise ValueError("an entry is too large for exact distances")
            if fresh:
                bounds = Bounds.fresh(x, groups)
            else:
                own = [b.column(n).to_numpy() for n in ("cluster", "own", "own_round")]
                lower = [matrix(b.column(n)) for n in ("lower", "lower_round")]
                bounds = Bounds(x, *[a.copy() for a in (*own, *lower)])
            bounds.advance(centers, gone)
            arrays = [
                b.column("vec_id"),
                b.column("x"),
                pa.array(bounds.cluster, pa.int32()),
                pa.array(bounds.before, pa.int32()),
                pa.array(bounds.own, pa.float64()),
                pa.array(bounds.own_round, pa.int32()),
                _lists(bounds.lower, pa.float64()),
                _lists(bounds.lower_round, pa.int32()),
                pa.array(bounds.distances(centers), pa.int64()),
                pa.array(bounds.scanned, pa.int64()),
            ]
            yield pa.RecordBatch.from_arrays(arrays, names)

    return state.mapInArrow(rows, _STATE)


def _change(state: DataFrame, k: int, dim: int) -> DataFrame:
    """What moved vectors add to the sums: cluster, dimension (or -1 for the count), total."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals = np.zeros((k, dim + 1), np.int64)
        for b in batches:
            if not b.num_rows:
                continue
            x = np.hstack([matrix(b.column("x")), np.ones((b.num_rows, 1), np.int64)])
            for name, sign in (("cluster", 1), ("before", -1)):
                cluster = b.column(name).to_numpy()
                for c in np.unique(cluster[cluster >= 0]).tolist():
                    totals[c] += sign * x[cluster == c].sum(axis=0)
        at = np.nonzero(totals)
        yield pa.RecordBatch.from_arrays(
            [pa.array(at[0], pa.int32()), pa.array(at[1], pa.int32()), pa.array(totals[at])],
            ["cluster", "dimension", "total"],
        )

    moved = state.where(F.col("cluster") != F.col("before")).select("x", "cluster", "before")
    per_task = moved.mapInArrow(rows, "cluster int, dimension int, total long")
    return per_task.groupBy("cluster", "dimension").agg(
        F.sum(F.col("total").cast("decimal(28,0)")).alias("total")
    )


def assignments(
    vectors: DataFrame,
    centroids: int = CENTROIDS,
    rounds: int = ROUNDS,
    dimensions: int = DIMENSIONS,
    groups: int = GROUPS,
) -> tuple[DataFrame, list[np.ndarray]]:
    """The last state of every vector, and the centroids of all rounds.

    The state's ``scanned`` is the number of distances that its last round measured.
    """
    right = finite_vector("embedding") & (F.size("embedding") == dimensions)
    kept = vectors.where(right).select("vec_id", fixed_point("embedding").alias("x"))
    kept = stored(kept, "vectors")
    chance = F.sha2(F.concat(F.lit("1:"), F.col("vec_id").cast("string")), 256)
    # As many rows as there are centroids.
    first = kept.orderBy(chance.asc_nulls_last(), "x").limit(centroids).select("x").collect()
    if not first:
        return kept.sparkSession.createDataFrame([], _STATE), []
    history = [np.array([row["x"] for row in first], np.int64)]
    if np.abs(history[0]).max() >= LARGEST or history[0].min() == np.iinfo(np.int64).min:
        raise ValueError("an entry is too large for exact distances")
    k, groups = len(first), min(groups, len(first))
    sums = [[0] * (dimensions + 1) for _ in range(k)]
    state = stored(_advance(kept, history, groups), "clusters")
    for _ in range(rounds):
        for row in _change(state, k, dimensions).collect():  # centroids times dimensions
            sums[row["cluster"]][row["dimension"]] += int(row["total"])
        moved = [
            [s // total[-1] for s in total[:-1]] if total[-1] else history[-1][c].tolist()
            for c, total in enumerate(sums)
        ]
        history.append(np.array(moved, np.int64))
        state = stored(_advance(state, history, groups), "clusters")
    return state, history


def clusters(
    vectors: DataFrame,
    centroids: int = CENTROIDS,
    rounds: int = ROUNDS,
    dimensions: int = DIMENSIONS,
    groups: int = GROUPS,
) -> DataFrame:
    """Per vector its cluster and squared distance, with its cluster's and all vectors' inertia."""
    spark = vectors.sparkSession
    state, history = assignments(vectors, centroids, rounds, dimensions, groups)
    inertia = {
        row["cluster"]: int(row["inertia"])
        for row in state.groupBy("cluster")
        .agg(F.sum(F.col("distance").cast("decimal(28,0)")).alias("inertia"))
        .collect()  # one row per centroid
    }
    digests = [
        hashlib.sha256(",".join(map(str, c)).encode()).hexdigest()
        for c in (history[-1].tolist() if history else [])
    ]
    about = spark.createDataFrame(
        [(c, own, sum(inertia.values()), digests[c]) for c, own in inertia.items()],
        "cluster int, cluster_inertia long, inertia long, centroid_sha256 string",
    )
    # One row per centroid, a parameter.
    return state.select("vec_id", "cluster", "distance").join(F.broadcast(about), "cluster").select(
        "vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"
    )
