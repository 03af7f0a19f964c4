import hashlib
import math
import random

import numpy as np
import pytest

from tidemark.llm import clustering, queries

TABLE = "vec_id long, embedding array<float>, cluster string, distance int, x int"


def table_of(spark, rows):
    return spark.createDataFrame([(i, v, "c", 1, 2) for i, v in rows], TABLE).repartition(3)


def brute(rows, k, rounds, dim):
    kept = [
        (i, [math.floor(64 * float(np.float32(c))) for c in v])
        for i, v in rows
        if v is not None and len(v) == dim and all(c is not None and math.isfinite(c) for c in v)
    ]
    order = sorted(
        kept,
        key=lambda r: (r[0] is None, hashlib.sha256(f"1:{r[0]}".encode()).hexdigest(), r[1]),
    )
    centers = [x for _, x in order[:k]]

    def nearest(x):
        return min((sum((a - b) ** 2 for a, b in zip(x, c)), j) for j, c in enumerate(centers))

    for _ in range(rounds):
        own = [nearest(x)[1] for _, x in kept]
        for j in range(len(centers)):
            group = [x for (_, x), c in zip(kept, own) if c == j]
            if group:
                centers[j] = [sum(col) // len(group) for col in zip(*group)]
    found = [(i, *nearest(x)[::-1]) for i, x in kept]
    every = sum(d for _, _, d in found)
    return [
        (i, j, d, sum(e for _, c, e in found if c == j), every,
         hashlib.sha256(",".join(map(str, centers[j])).encode()).hexdigest())
        for i, j, d in found
    ]


def same(got, want):
    assert sorted(map(tuple, got), key=repr) == sorted(want, key=repr)


@pytest.mark.parametrize("groups", [1, 3, 8])
def test_equals_a_full_search(spark, groups):
    rng = random.Random(groups)
    rows = [(i, [rng.gauss(i % 7, 0.8) for _ in range(4)]) for i in range(200)]
    rows += [(500 + i, [float(i % 3), 0.0, 0.0, 1.0]) for i in range(40)]  # ties and copies
    rows += [(3, rows[3][1]), (3, [0.5] * 4), (None, [1.0] * 4), (None, [2.0] * 4)]
    rows += [(900, None), (901, []), (902, [1.0] * 3), (903, [1.0, None, 1.0, 1.0])]
    rows += [(904, [math.nan] * 4), (905, [math.inf, 0.0, 0.0, 0.0]), (906, [-0.01] * 4)]
    got = clustering.clusters(table_of(spark, rows), 8, 5, 4, groups)
    same(got.collect(), brute(rows, 8, 5, 4))


def test_few_vectors_and_none(spark):
    rows = [(1, [0.0, 1.0]), (2, [0.0, 1.0]), (3, [5.0, 5.0])]
    same(clustering.clusters(table_of(spark, rows), 16, 3, 2).collect(), brute(rows, 16, 3, 2))
    assert clustering.clusters(table_of(spark, []), 16, 3, 2).count() == 0
    with pytest.raises(Exception, match="too large"):
        clustering.clusters(table_of(spark, [(1, [3e38, 0.0])]), 16, 3, 2).count()


def test_bounds_hold_over_many_rounds():
    """Every bound stays below the true distance however the centroids wander, back and forth too."""
    rng = np.random.default_rng(5)
    x = rng.integers(-300, 300, (400, 6))
    history = [rng.integers(-300, 300, (10, 6))]
    bounds = clustering.Bounds.fresh(x, 4)
    measured = []
    for t in range(25):
        if t:
            step = rng.integers(-20, 20, (10, 6)) if t % 2 else history[-2] - history[-1]
            history.append(history[-1] + step)
        centers = history[-1]
        gone = np.stack([np.sqrt(((centers - c) ** 2).sum(axis=1).astype(float)) for c in history])
        bounds.scanned[:] = 0
        bounds.advance(centers, gone)
        squares = ((x[:, None, :] - centers[None]) ** 2).sum(axis=2)
        assert (bounds.cluster == squares.argmin(axis=1)).all()
        assert (bounds.distances(centers) == squares.min(axis=1)).all()
        for g in range(4):
            others = np.where(
                (np.arange(10) % 4 == g) & (np.arange(10) != bounds.cluster[:, None]),
                np.sqrt(squares),
                np.inf,
            ).min(axis=1)
            loose = bounds.lower[:, g] - np.array(
                [gone[s, np.arange(10) % 4 == g].max() for s in bounds.lower_round[:, g]]
            )
            assert (loose <= others + 1e-6).all()
        measured.append(bounds.scanned.sum())
    # Centroids that come back leave no trace in the bounds; summed drifts would rescan everything.
    assert sum(measured[1:]) < 0.6 * 24 * 400 * 10


def test_later_rounds_measure_fewer_distances(spark):
    rng = random.Random(8)
    rows = [(i, [rng.gauss(4 * (i % 8), 0.5) for _ in range(6)]) for i in range(400)]
    state, history = clustering.assignments(table_of(spark, rows), 8, 4, 6, 8)
    assert len(history) == 5
    assert state.agg({"scanned": "sum"}).first()[0] < 400 * 4


def test_query_on_the_whole_table(spark, folder):
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{folder}/embeddings.parquet").collect()]
    same(queries.op12_clustering(spark, folder).collect(), brute(rows, 16, 3, 64))
