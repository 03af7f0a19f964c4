import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tests.helpers import frame, same, txn
from tidemark.operators import daily, sketches, staging
from tidemark.sources.feature_tables import write_days

NOW = "2025-01-01 00:00:00"
START = datetime(2024, 1, 1, 12)
UPTO = (START + timedelta(days=95)).date()


@pytest.fixture(scope="module")
def txns(spark):
    rng = random.Random(1)
    rows = [
        txn(f"e{k}", "wide", START + timedelta(days=k % 96), rng.lognormvariate(3, 1), f"m{rng.randrange(4000)}")
        for k in range(9000)
    ]
    rows += [
        txn(f"f{k}", "small", START + timedelta(days=80 + k), 10.0 + k, [None, "m1", "m2"][k % 3])
        for k in range(10)
    ]
    rows += [txn("g", "old", START + timedelta(days=6), 5.0), txn("h", "older", START, 5.0)]
    rows += [txn("i", "nameless", START + timedelta(days=90), 5.0, None, is_online=True)]
    return staging.clean(frame(spark, rows), NOW).cache()


def stored(spark, txns, path):
    first = (START + timedelta(days=4)).date()
    write_days(sketches.day_sketches(txns, first, UPTO), path)
    return spark.read.parquet(path)


def test_every_estimate_is_within_its_stated_error(spark, txns, tmp_path):
    day_table = stored(spark, txns, str(tmp_path / "s"))
    found = sketches.estimates(sketches.window_sketches(day_table, UPTO)).cache()
    report = sketches.accuracy(found, txns, UPTO)
    rows = {(r.account_id, r.window_days): r for r in report.collect()}
    assert set(rows) == {
        *[("wide", w) for w in (7, 30, 90)],
        *[("small", w) for w in (7, 30, 90)],
        *[("nameless", w) for w in (7, 30, 90)],
        ("old", 90),
    }
    for r in rows.values():
        assert r.merchants_within and r.p50_within and r.p95_within and r.p99_within, r
    got = {(r.account_id, r.window_days): r for r in found.collect()}
    assert rows["wide", 90].exact_merchants > 3000
    assert got["wide", 90].distinct_merchants != rows["wide", 90].exact_merchants  # an estimate
    assert got["small", 90].distinct_merchants == 2 and got["small", 90].p50 in (14.0, 15.0)
    assert got["nameless", 7].distinct_merchants == 0


def test_the_report_finds_a_wrong_estimate(spark, txns, tmp_path):
    day_table = stored(spark, txns, str(tmp_path / "s"))
    found = sketches.estimates(sketches.window_sketches(day_table, UPTO))
    wrong = found.withColumns(
        {"distinct_merchants": F.col("distinct_merchants") * 2 + 1, "p95": F.col("p50")}
    )
    row = sketches.accuracy(wrong, txns, UPTO).where("account_id = 'wide' AND window_days = 90").first()
    assert (row.merchants_within, row.p50_within, row.p95_within) == (False, True, False)


def test_windows_are_read_from_stored_days_only(spark, txns, tmp_path):
    path = str(tmp_path / "s")
    united = sketches.window_sketches(stored(spark, txns, path), UPTO, (7,))
    assert united.inputFiles() and all(path in f for f in united.inputFiles())
    plan = united._jdf.queryExecution().executedPlan().toString()
    assert "transaction_date" in plan[plan.index("PartitionFilters") :][:200]


def test_sketches_merge_in_any_split(spark, txns):
    one = sketches.day_sketches(txns, UPTO - timedelta(days=90), UPTO)
    many = sketches.day_sketches(txns.repartition(7), UPTO - timedelta(days=90), UPTO)
    a, b = (
        sketches.estimates(sketches.window_sketches(s, UPTO)).select(
            "account_id", "window_days", "n", "distinct_merchants"
        )
        for s in (one, many)
    )
    a, b = a.where("account_id <> 'wide'"), b.where("account_id <> 'wide'")
    assert same(a, b)


def test_features_with_estimates(spark, txns, tmp_path):
    path = str(tmp_path / "c")
    first = UPTO - timedelta(days=90)
    write_days(sketches.day_categories(txns, first, UPTO), path)
    got = sketches.estimated_features(
        sketches.day_sketches(txns, first, UPTO), spark.read.parquet(path), UPTO, NOW
    )
    want = daily.daily_features(txns, UPTO, NOW)
    assert got.columns == want.columns
    estimated = ["distinct_merchants_30d", "distinct_merchants_7d", *daily.PERCENTILES]

    def exact(df):
        doubles = [n for n, t in df.dtypes if t == "double" and n not in estimated]
        return df.drop(*estimated).withColumns({n: F.round(n, 8) for n in doubles})

    assert same(exact(got), exact(want))
    none = sketches.estimated_features(
        sketches.day_sketches(txns, "2020-01-01"), sketches.day_categories(txns, "2020-01-01"), "2020-01-01", NOW
    )
    assert none.isEmpty()
