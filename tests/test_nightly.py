import pytest
from pyspark.sql import functions as F

from tests.helpers import same
from tidemark import schemas as S
from tidemark.operators import serving, snapshots
from tidemark.plans import nightly
from tidemark.sources import logs, tables


@pytest.fixture
def txns(spark, folder):
    return tables.transactions(spark, folder)


def test_run_twice_gives_the_same_tables(spark, txns, tmp_path):
    paths = nightly.Paths.under(str(tmp_path))
    first = nightly.run_daily(spark, txns, paths, "2024-01-29", "2024-01-29 02:00:00")
    assert [(s.name, s.state, s.rows) for s in first] == [
        ("build", "done", None),
        ("fetch", "done", 15),
        ("snapshot", "done", 15),
        ("serving", "done", 15),
        ("quality", "done", None),
    ]
    assert "min_accounts: warn" in first[-1].note
    tables_ = [
        spark.read.parquet(paths.daily),
        spark.read.parquet(paths.rolling),
        logs.read_log(spark, paths.snapshots, nightly.SNAPSHOT),
        serving.read_serving(spark, paths.serving, "batch"),
    ]
    kept = [spark.createDataFrame(t.collect(), t.schema) for t in tables_]
    second = nightly.run_daily(spark, txns, paths, "2024-01-29", "2024-01-29 02:00:00")
    assert second == first
    again = [
        spark.read.parquet(paths.daily),
        spark.read.parquet(paths.rolling),
        logs.read_log(spark, paths.snapshots, nightly.SNAPSHOT),
        serving.read_serving(spark, paths.serving, "batch"),
    ]

    def settled(df):
        doubles = [n for n, t in df.dtypes if t == "double"]
        return df.withColumns({n: F.round(n, 8) for n in doubles})

    assert all(same(settled(a), settled(b)) for a, b in zip(kept, again))


def test_two_days_and_time_travel(spark, txns, tmp_path):
    paths = nightly.Paths.under(str(tmp_path))
    for day in ("2024-01-20", "2024-01-21"):
        assert nightly.run_daily(spark, txns, paths, day, f"{day} 02:00:00")[-1].state == "done"
    snaps = logs.read_log(spark, paths.snapshots, nightly.SNAPSHOT)
    assert snapshots.commits(snaps).count() == 2
    then = snapshots.features_at(snaps, "2024-01-20 12:00:00")
    assert {str(r.computed_at) for r in then.collect()} == {"2024-01-20 02:00:00"}
    live = serving.live(serving.read_serving(spark, paths.serving, "batch"), "2024-01-21 03:00:00")
    assert {str(r.computed_at) for r in live.collect()} == {"2024-01-21 02:00:00"}
    stored = serving.read_serving(spark, paths.serving, "batch")
    assert serving.live(stored, "2024-01-23 03:00:00").count() == 0


def test_an_empty_date_ends_the_run(spark, txns, tmp_path):
    paths = nightly.Paths.under(str(tmp_path))
    for date, end in (("2020-01-01", "empty"), ("2024-01-29", "done"), ("2020-01-01", "empty")):
        steps = nightly.run_daily(spark, txns, paths, date, "2024-02-05 00:00:00")
        assert steps[-1].state == end, steps
        assert len(steps) == (2 if end == "empty" else 5)


def test_failure_names_its_step(spark, txns, tmp_path):
    paths = nightly.Paths.under(str(tmp_path))
    (tmp_path / S.BATCH_SNAPSHOTS).write_text("in the way")
    steps = nightly.run_daily(spark, txns, paths, "2024-01-29", "2024-01-29 02:00:00")
    assert [(s.name, s.state) for s in steps[-2:]] == [("fetch", "done"), ("snapshot", "failed")]
    assert steps[-1].note


def test_a_rerun_follows_corrected_input(spark, txns, tmp_path):
    paths = nightly.Paths.under(str(tmp_path))
    args = (paths, "2024-01-29", "2024-01-29 02:00:00")
    nightly.run_daily(spark, txns, *args)
    serving.compact_serving(spark, paths.serving, "batch", "2024-01-29 02:30:00")
    ones = txns.withColumn("amount", F.lit(1.0))
    assert nightly.run_daily(spark, ones, *args)[-1].state == "done"
    rolling = spark.read.parquet(paths.rolling).where("metric_name = 'avg_amount'")
    assert {r.metric_value for r in rolling.collect()} <= {0.0, 1.0}
    live = serving.live(serving.read_serving(spark, paths.serving, "batch"), "2024-01-29 03:00:00")
    assert {r.avg_txn_amount_30d for r in live.collect()} == {1.0}
