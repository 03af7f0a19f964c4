import hashlib
import math
import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tidemark.functions.clock import hour_of_day, is_weekend
from tidemark.functions.geo import haversine_km
from tidemark.functions.keys import route_partition, serving_key
from tidemark.functions.numbers import snap, velocity
from tidemark.functions.quantiles import grouped_quantiles


def _km(spark, *degrees):
    row = spark.createDataFrame([degrees], "a double, b double, c double, d double")
    return row.select(haversine_km(*[F.col(c) for c in "abcd"]).alias("km")).first()["km"]


def test_distance_on_meridians_poles_and_the_date_line(spark):
    quarter = math.pi * 6371.0 / 2
    assert _km(spark, 0.0, 25.0, 90.0, -61.0) == pytest.approx(quarter)
    assert _km(spark, 90.0, 10.0, 90.0, 170.0) == pytest.approx(0.0, abs=1e-6)
    assert _km(spark, 0.0, 179.5, 0.0, -179.5) == pytest.approx(quarter / 90)
    assert _km(spark, -33.0, 18.0, -33.0, 18.0) == 0.0
    there, back = _km(spark, 64.1, -21.9, -1.3, 36.8), _km(spark, -1.3, 36.8, 64.1, -21.9)
    assert there == pytest.approx(back) and 0 < there < 2 * quarter


def test_distance_of_antipodes_is_half_the_girth(spark):
    assert _km(spark, 12.3, 45.6, -12.3, -134.4) == pytest.approx(math.pi * 6371.0)


@pytest.mark.parametrize("missing", range(4))
def test_distance_is_null_when_a_coordinate_is(spark, missing):
    degrees = [5.5, 6.5, 7.5, 8.5]
    degrees[missing] = None
    assert _km(spark, *degrees) is None


def test_hour_and_weekend(spark):
    times = [
        (datetime(2023, 7, 1, 0, 0) + timedelta(hours=k), k % 24, k // 24 % 7 in (0, 1))
        for k in range(0, 24 * 9, 5)
    ]
    df = spark.createDataFrame(times, "ts timestamp_ntz, h int, w boolean")
    ts = F.col("ts")
    got = df.select("*", hour_of_day(ts).alias("gh"), is_weekend(ts).alias("gw"))
    for row in got.collect():
        assert (row.gh, row.gw) == (row.h, row.w)


def test_hour_in_another_zone(spark):
    df = spark.createDataFrame([(datetime(2022, 6, 30, 20, 45),)], "ts timestamp_ntz")
    got = df.select(hour_of_day(F.col("ts"), "Asia/Tokyo").alias("h")).first()["h"]
    assert got == 5


def test_route_partition_matches_md5(spark):
    accounts = [f"acct_{i:05d}" for i in range(200)] + ["", "ünï"]
    df = spark.createDataFrame([(a,) for a in accounts], "a string")
    for row in df.select("a", route_partition(F.col("a")).alias("p")).collect():
        expected = int.from_bytes(hashlib.md5(row.a.encode()).digest()[:4], "big") % 8
        assert row.p == expected


def test_serving_key(spark):
    df = spark.createDataFrame([("left bank",)], "a string")
    key = df.select(serving_key(F.col("a"), F.lit("batch"), "own").alias("k"))
    assert key.first()["k"] == "own:left bank:batch"


def test_velocity_modes(spark):
    rows = [(0, 0), (1, 1), (3, 6), (5, 30), (12, 60)]
    df = spark.createDataFrame(rows, "n5 bigint, n1 bigint")
    n5, n1 = F.col("n5"), F.col("n1")
    got = df.select(
        velocity(n5, n1).alias("s"),
        velocity(n5, n1, "hourly").alias("h"),
        velocity(n5, n1, "per_minute").alias("m"),
    ).collect()
    assert [r.s for r in got] == [0.0, 1.0, 1.0, 1.0, 2.4]
    assert [r.h for r in got] == [0.0, 0.0167, 0.1, 0.5, 1.0]
    assert [r.m for r in got] == [0.0, 0.2, 0.6, 1.0, 2.4]
    with pytest.raises(ValueError):
        velocity(n5, n1, "other")


def test_snap_ignores_float_noise(spark):
    df = spark.createDataFrame([(0.125,), (0.12499999999999,), (2.675,)], "x double")
    assert [r.y for r in df.select(snap(F.col("x"), 2).alias("y")).collect()] == [0.13, 0.13, 2.68]


def _expected(values, p, method):
    values = sorted(values)
    n = len(values)
    if method == "nearest":
        return values[min(int(n * p), n - 1)]
    at = p * (n - 1)
    low, high = math.floor(at), math.ceil(at)
    return values[low] + (at - low) * (values[high] - values[low])


@pytest.mark.parametrize("method", ["linear", "nearest"])
@pytest.mark.parametrize(("per_octave", "crowded"), [(1, 0), (1, 20), (4096, 10_000)])
def test_grouped_quantiles_against_sorting(spark, method, per_octave, crowded):
    rng = random.Random(7)
    groups = {
        "one": [3.0],
        "two": [1.0, 9.0],
        "flat": [5.0] * 40,
        "mixed": [rng.choice([-1, 1]) * rng.expovariate(0.01) for _ in range(301)],
        "skewed": [9.99] * 500 + [rng.uniform(0, 1e6) for _ in range(77)],
        "zeros": [0.0] * 3 + [0.01],
    }
    rows = [(k, v) for k, vs in groups.items() for v in vs] + [("mixed", None), ("nulls", None)]
    rng.shuffle(rows)
    probs = {"p0": 0.0, "p50": 0.5, "p95": 0.95, "p99": 0.99, "p100": 1.0}
    df = spark.createDataFrame(rows, "k string, v double")
    found = grouped_quantiles(df, ["k"], "v", probs, method, per_octave, crowded=crowded)
    counted = df.groupBy("k", "v").agg(F.count(F.lit(1)).alias("times"))
    weighted = grouped_quantiles(
        counted, ["k"], "v", probs, method, per_octave, "times", crowded=crowded
    )
    got = {r.k: r for r in found.collect()}
    assert set(got) == set(groups) and got == {r.k: r for r in weighted.collect()}
    for k, values in groups.items():
        for name, p in probs.items():
            assert got[k][name] == pytest.approx(_expected(values, p, method)), (k, name)


def _quantiles(spark, values, probs):
    df = spark.createDataFrame([("k", v) for v in values], "k string, v double")
    row = grouped_quantiles(df, ["k"], "v", {f"p{i}": p for i, p in enumerate(probs)}).first()
    return [row[f"p{i}"] for i in range(len(probs))]


def test_nan_is_the_largest_value(spark):
    half, most = _quantiles(spark, [float("nan"), 5.0, 6.0, 7.0], [0.5, 1.0])
    assert half == 6.5 and math.isnan(most)


@pytest.mark.parametrize(("low", "high"), [(50_000.0, 50_008.0), (1e-9, 3e-6), (-2e-7, 1e-7)])
def test_crowded_values(spark, low, high):
    rng = random.Random(4)
    values = [rng.uniform(low, high) for _ in range(20_000)]
    probs = [0.0, 0.25, 0.5, 0.99, 1.0]
    got = _quantiles(spark, values, probs)
    assert got == pytest.approx([_expected(values, p, "linear") for p in probs], rel=1e-12)


def test_a_cluster_needs_a_shared_folder():
    class Session:
        def __init__(self, **settings):
            self.conf = self
            self.settings = settings

        def get(self, key, default=None):
            return self.settings.get(key, default)

    from tidemark.session import shared_dir

    here = {"spark.sql.warehouse.dir": "/w"}
    assert shared_dir(Session(**here, **{"spark.master": "local[4]"})) == "/w/tidemark-work"
    assert shared_dir(Session(**here, **{"spark.checkpoint.dir": "/s", "spark.master": "yarn"})) == "/s"
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        shared_dir(Session(**here, **{"spark.master": "spark://host:7077"}))
