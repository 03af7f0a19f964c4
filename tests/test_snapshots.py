import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tests.helpers import T0, frame, minutes, realtime, same
from tidemark import schemas as S
from tidemark.operators import snapshots
from tidemark.sources import logs
from tidemark.streaming.panes import SNAPSHOT


def _log(spark, entries):
    """Entries of (row, committed_at)."""
    rows = None
    for row, at in entries:
        one = snapshots.stamp(frame(spark, [row], S.REALTIME), 1, at)
        rows = one if rows is None else rows.unionByName(one)
    return rows


def _requests(spark, rows):
    return spark.createDataFrame(rows, "account_id string, as_of timestamp_ntz, label string")


def test_asof_takes_the_newest_visible_row(spark):
    log = _log(
        spark,
        [
            (realtime("a", minutes(0), txn_count_1h=1), minutes(1)),
            (realtime("a", minutes(10), txn_count_1h=2), minutes(11)),
            (realtime("a", minutes(5), txn_count_1h=9), minutes(20)),
            (realtime("b", minutes(0), txn_count_1h=7), minutes(30)),
        ],
    )
    asked = [
        ("a", minutes(0), "before"),
        ("a", minutes(1), "edge"),
        ("a", minutes(15), "second"),
        ("a", minutes(25), "late commit of older features"),
        ("b", minutes(29), "not yet"),
        ("c", minutes(29), "unknown"),
        ("a", minutes(60 * 24 * 3), "days later"),
    ]
    out = snapshots.features_asof(log, _requests(spark, asked))
    got = {r.label: r.txn_count_1h for r in out.collect()}
    assert got == {
        "before": None,
        "edge": 1,
        "second": 2,
        "late commit of older features": 2,
        "not yet": None,
        "unknown": None,
        "days later": 2,
    }


@pytest.mark.parametrize("slice_minutes", [1, 60, 1440])
def test_asof_against_brute_force(spark, slice_minutes):
    rng = random.Random(5)
    entries, asked = [], []
    for i in range(400):
        account = "hot" if rng.random() < 0.4 else f"a{rng.randrange(8)}"
        at = minutes(rng.randrange(3000))
        committed = at + timedelta(seconds=rng.randrange(0, 7200))
        entries.append((realtime(account, at, txn_count_1h=i), committed))
        asked.append((account, minutes(rng.randrange(3200)), f"r{i}"))
    at_by_id = {i: c for i, (_, c) in enumerate(entries)}
    rows = frame(spark, [r for r, _ in entries], S.REALTIME)
    times = spark.createDataFrame(list(at_by_id.items()), "txn_count_1h bigint, at timestamp_ntz")
    log = snapshots.stamp(rows.join(times, "txn_count_1h"), 1, F.col("at")).drop("at")
    out = snapshots.features_asof(
        log, _requests(spark, asked), slice_micros=slice_minutes * 60_000_000
    ).collect()
    got = {r.label: (r.computed_at, r.committed_at) for r in out}
    assert len(out) == len(asked)
    for account, as_of, label in asked:
        seen = [
            (r["computed_at"], c)
            for r, c in entries
            if r["account_id"] == account and c <= as_of
        ]
        assert got[label] == (max(seen) if seen else (None, None))


def test_asof_lookback_guard(spark):
    log = _log(spark, [(realtime("a", minutes(0)), minutes(0))])
    asked = _requests(spark, [("a", T0 + timedelta(days=d), f"{d}") for d in (1, 10)])
    now = T0 + timedelta(days=35)
    out = snapshots.features_asof(log, asked, now=now, max_lookback_days=30).collect()
    assert {r.label: r.txn_count_1h for r in out} == {"1": None, "10": 5}


def test_features_at_one_moment(spark):
    log = _log(
        spark,
        [
            (realtime("a", minutes(0), txn_count_1h=1), minutes(0)),
            (realtime("a", minutes(9), txn_count_1h=2), minutes(9)),
            (realtime("b", minutes(3), txn_count_1h=3), minutes(3)),
        ],
    )
    assert {r.account_id: r.txn_count_1h for r in snapshots.features_at(log, minutes(5)).collect()} == {
        "a": 1,
        "b": 3,
    }
    assert snapshots.features_at(log, minutes(5), "b").count() == 1
    assert snapshots.features_at(log, minutes(-1)).count() == 0


def test_history_is_inclusive_and_ordered(spark):
    log = _log(spark, [(realtime("a", minutes(m), txn_count_1h=m), minutes(m)) for m in (9, 1, 5, 3)])
    out = snapshots.feature_history(log, minutes(1), minutes(5), "a").collect()
    assert [r.txn_count_1h for r in out] == [1, 3, 5]


def _pairs(spark, *accounts):
    rows = [(a, minutes(0), minutes(30)) for a in accounts]
    return spark.createDataFrame(
        rows, "account_id string, timestamp_a timestamp_ntz, timestamp_b timestamp_ntz"
    )


def test_diff(spark):
    before = dict(txn_count_1h=11, txn_amount_sum_1h=6.5, is_new_merchant=False)
    after = dict(txn_count_1h=4, txn_amount_sum_1h=9.25, is_new_merchant=True)
    log = _log(
        spark,
        [
            (realtime("a", minutes(0), **before), minutes(0)),
            (realtime("a", minutes(20), **after), minutes(20)),
            (realtime("same", minutes(0)), minutes(0)),
            (realtime("late", minutes(10)), minutes(10)),
        ],
    )
    out = snapshots.feature_diff(log, _pairs(spark, "a", "same", "late", "none")).collect()
    got = {(r.account_id, r.feature): (r.before, r.after, r.delta) for r in out}
    assert got == {
        ("a", "txn_count_1h"): ("11", "4", -7.0),
        ("a", "txn_amount_sum_1h"): ("6.5", "9.25", 2.75),
        ("a", "is_new_merchant"): ("false", "true", 1.0),
    }
    wide = snapshots.feature_diff(log, _pairs(spark, "a"), include_computed_at=True).collect()
    assert {r.feature for r in wide} - {f for _, f in got} == {"computed_at"}


def test_diff_of_nan_and_null(spark):
    log = _log(
        spark,
        [
            (realtime("a", minutes(0), txn_velocity_5m=float("nan"), distance_from_home=None), minutes(0)),
            (realtime("a", minutes(9), txn_velocity_5m=float("nan"), distance_from_home=1.0), minutes(9)),
        ],
    )
    rows = snapshots.feature_diff(log, _pairs(spark, "a")).collect()
    assert [(r.feature, r.before, r.after, r.delta) for r in rows] == [
        ("distance_from_home", None, "1.0", None)
    ]


def test_expiry_keeps_the_newest_and_the_young(spark):
    now = datetime(2024, 3, 1)
    rows = [(i, now - timedelta(days=i), 1) for i in range(1, 60)]
    commits = spark.createDataFrame(rows, "snapshot_id bigint, committed_at timestamp_ntz, num_rows bigint")
    gone = snapshots.snapshots_to_expire(commits, now)
    assert sorted(r.snapshot_id for r in gone.collect()) == list(range(31, 60))
    old = commits.where("snapshot_id > 40")
    gone = snapshots.snapshots_to_expire(old, now)
    assert sorted(r.snapshot_id for r in gone.collect()) == list(range(51, 60))


def test_append_is_idempotent_and_compaction_keeps_reads(spark, tmp_path):
    path = str(tmp_path / "snaps")
    logs.create_log(spark, path, SNAPSHOT)
    assert logs.read_log(spark, path, SNAPSHOT).count() == 0
    for batch_id in (0, 1, 1, 2):
        rows = snapshots.stamp(
            frame(spark, [realtime("a", minutes(batch_id)), realtime("b", minutes(batch_id))], S.REALTIME),
            batch_id,
            minutes(batch_id),
        )
        assert logs.append_batch(rows, path, batch_id) == 2
    before = logs.read_log(spark, path, SNAPSHOT)
    assert before.count() == 6
    kept = spark.createDataFrame(before.collect(), before.schema)
    assert logs.compact(spark, path, SNAPSHOT, files=2) is not None
    assert same(kept, logs.read_log(spark, path, SNAPSHOT))
    assert logs.compact(spark, path, SNAPSHOT) is not None
    late = snapshots.stamp(frame(spark, [realtime("c")], S.REALTIME), 3, minutes(3))
    logs.append_batch(late, path, 3)
    assert logs.read_log(spark, path, SNAPSHOT).count() == 7
    empty = late.where("false")
    assert logs.append_batch(empty, path, 4) == 0


def test_compaction_may_purge_accounts(spark, tmp_path):
    path = str(tmp_path / "snaps")
    logs.create_log(spark, path, SNAPSHOT)
    rows = snapshots.stamp(
        frame(spark, [realtime("a"), realtime("b")], S.REALTIME), 0, minutes(0)
    )
    logs.append_batch(rows, path, 0)
    gone = spark.createDataFrame([("a",)], "account_id string")
    logs.compact(spark, path, SNAPSHOT, lambda df: df.join(gone, "account_id", "left_anti"))
    assert [r.account_id for r in logs.read_log(spark, path, SNAPSHOT).collect()] == ["b"]
    logs.compact(spark, path, SNAPSHOT, lambda df: df.where("false"))
    assert logs.read_log(spark, path, SNAPSHOT).count() == 0
