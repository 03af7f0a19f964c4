import math
import random
from collections import Counter
from fractions import Fraction

import numpy as np
import pytest

from tidemark.llm import queries, whitening

TABLE = "vec_id long, embedding array<float>, n string, component int, x int"


def table_of(spark, rows):
    return spark.createDataFrame([(i, v, "c", 1, 2) for i, v in rows], TABLE).repartition(3)


def kept(rows):
    finite = [
        (i, v) for i, v in rows if v and all(c is not None and math.isfinite(c) for c in v)
    ]
    lengths = Counter(len(v) for _, v in finite)
    most = min(lengths, key=lambda n: (-lengths[n], n))
    return [
        (i, [math.floor(64 * float(np.float32(c))) + 1_000_000 for c in v])
        for i, v in finite
        if len(v) == most
    ]


def check(got, rows, components=32):
    rows = kept(rows)
    n = len(rows)
    dim = len(rows[0][1])
    sums = [sum(col) for col in zip(*(x for _, x in rows))]
    y = [[n * a - s for a, s in zip(x, sums)] for _, x in rows]
    v = np.array(
        [[float(Fraction(sum(r[d] * r[e] for r in y), n**3)) for e in range(dim)] for d in range(dim)]
    )
    values = np.sort(np.linalg.eigvalsh(v))[::-1][:components]
    values = values[values > 1e-11 * np.trace(v)]
    assert len(got) == n * len(values)
    far = Counter((i, sum(a * a for a in r)) for (i, _), r in zip(rows, y))
    assert Counter((r.vec_id, int(r.deviation)) for r in got) == {
        k: c * len(values) for k, c in far.items()
    }
    assert all(r.n == n and r.identity_error < 1e-9 for r in got)
    centred = np.array(y, float) / n
    exact, axes = np.linalg.eigh(v)
    order = np.argsort(-exact)[: len(values)]
    for k, j in enumerate(order, 1):
        own = [r for r in got if r.component == k]
        assert np.allclose([r.explained for r in own], exact[j] / np.trace(v), rtol=1e-9)
        want = centred @ axes[:, j] / math.sqrt(exact[j])
        have = sorted((r.vec_id is None, r.vec_id or 0, r.whitened) for r in own)
        matches = []
        for sign in (1, -1):
            expected = sorted((i is None, i or 0, sign * w) for (i, _), w in zip(rows, want))
            matches.append(np.allclose([h[2] for h in have], [e[2] for e in expected], atol=1e-6))
        assert any(matches)


def test_equals_products_of_centred_values(spark):
    rng = random.Random(1)
    base = [[rng.gauss(0, 1) for _ in range(5)] for _ in range(120)]
    rows = [(i, [a, a + 0.3 * b, 3 * c, d - c, 100 + e / 4]) for i, (a, b, c, d, e) in enumerate(base)]
    rows += [(5, rows[5][1]), (None, rows[9][1]), (200, [1.0] * 4), (201, None), (202, [])]
    rows += [(203, [1.0, None, 0.0, 0.0, 0.0]), (204, [math.nan] * 5), (205, [-math.inf] * 5)]
    check(whitening.whitened(table_of(spark, rows)).collect(), rows)
    check(whitening.whitened(table_of(spark, rows), 2).collect(), rows, 2)


def test_flat_directions_are_left_out(spark):
    rng = random.Random(2)
    rows = [(i, [a := rng.gauss(0, 1), 7.0, rng.gauss(5, 2)]) for i in range(50)]
    got = whitening.whitened(table_of(spark, rows)).collect()
    assert {r.component for r in got} == {1, 2}
    check(got, rows)
    assert whitening.whitened(table_of(spark, [(1, [2.0, 3.0])] * 4)).count() == 0
    assert whitening.whitened(table_of(spark, [])).count() == 0
    assert whitening.whitened(table_of(spark, [(1, None), (2, [])])).count() == 0


def test_large_entries_stay_exact(spark):
    rng = random.Random(3)
    rows = [(i, [rng.uniform(-1, 1) * 2**33, rng.uniform(0, 1), 2.0**30 + i]) for i in range(40)]
    whitened = whitening.whitened(table_of(spark, rows)).collect()
    exact = kept(rows)
    n, sums = len(exact), [sum(c) for c in zip(*(x for _, x in exact))]
    far = {i: sum((n * a - s) ** 2 for a, s in zip(x, sums)) for i, x in exact}
    assert whitened and all(int(r.deviation) == far[r.vec_id] for r in whitened)
    with pytest.raises(Exception, match="too large"):
        whitening.whitened(table_of(spark, [(1, [3e38, 0.0]), (2, [1.0, 1.0])])).count()


def test_covariance_comes_from_squares_alone():
    rng = np.random.default_rng(4)
    x = rng.integers(-50, 50, (30, 4)) + 1_000_000
    n, sums = len(x), x.sum(axis=0).tolist()
    middle = [(2 * s + n) // (2 * n) for s in sums]
    u = x - np.array(middle)
    squares = {
        (d, e): int(((u[:, d] if d == e else u[:, d] + u[:, e]) ** 2).sum())
        for d in range(4)
        for e in range(d, 4)
    }
    want = np.cov(x.T.astype(float) - 1_000_000, bias=True)
    assert np.allclose(whitening.covariance(n, sums, middle, squares), want, rtol=1e-12)


def test_query_on_the_whole_table(spark, folder):
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{folder}/embeddings.parquet").collect()]
    got = queries.op13_whitening(spark, folder)
    assert dict(got.dtypes)["deviation"] == "bigint"
    check(got.collect(), rows)
