from datetime import datetime, timedelta

from pyspark.sql import functions as F

from tests.helpers import T0, frame, minutes, txn
from tidemark.operators import hopping, serving, snapshots
from tidemark.sources import logs
from tidemark.streaming import panes

def test_expiry_deletes_what_it_lists(spark, tmp_path):
    path = str(tmp_path / "snaps")
    schema = "account_id string, computed_at timestamp_ntz, committed_at timestamp_ntz, snapshot_id bigint"
    kind = spark.createDataFrame([], schema).schema
    logs.create_log(spark, path, kind)
    now = datetime(2024, 3, 1)
    for n in range(5):
        at = now - timedelta(days=20 * n)
        row = spark.createDataFrame([("a", at, at, n)], kind)
        logs.append_batch(row, path, n)
    snapshots.expire_snapshots(spark, path, kind, now, max_age_days=30, keep=3)
    left = logs.read_log(spark, path, kind)
    # Two are young enough, a third is among the newest three.
    assert sorted(r.snapshot_id for r in left.collect()) == [0, 1, 2]
    stored = list((tmp_path / "snaps" / "log").rglob("batch_id=*"))
    assert stored == []


def test_what_arrives_while_a_compaction_runs_stays(spark, tmp_path):
    path = str(tmp_path / "log")
    kind = spark.createDataFrame([], "account_id string, n bigint").schema

    def put(n, batch_id, stream="main"):
        logs.append_batch(spark.createDataFrame([("a", n)], kind), path, batch_id, stream=stream)

    def seen():
        return sorted(r.n for r in logs.read_log(spark, path, kind).collect())

    logs.create_log(spark, path, kind)
    assert logs.compact(spark, path, kind) is None and logs.remove_folded(spark, path) == 0
    put(1, 7)
    put(2, 7, "second")

    def fold(rows):
        put(3, 2)  # after the log was listed
        return rows

    logs.compact(spark, path, kind, fold)
    assert seen() == [1, 2, 3]
    assert logs.remove_folded(spark, path) == 2
    assert seen() == [1, 2, 3]
    put(4, 7, "second")
    assert seen() == [1, 3, 4]
    logs.compact(spark, path, kind)
    put(5, 2)
    assert seen() == [1, 4, 5]
    assert logs.remove_folded(spark, path) == 1
    assert seen() == [1, 4, 5]
    assert [p.name for p in (tmp_path / "log" / "compacted").iterdir() if p.is_dir()] == ["1"]


def test_a_compaction_that_was_not_finished_does_not_count(spark, tmp_path):
    path = str(tmp_path / "log")
    kind = spark.createDataFrame([], "account_id string, n bigint").schema
    logs.create_log(spark, path, kind)
    logs.append_batch(spark.createDataFrame([("a", 1)], kind), path, 0)
    half = spark.createDataFrame([("b", 2, "main", 0)], "account_id string, n bigint, stream string, batch_id bigint")
    half.write.parquet(f"{path}/compacted/0/rows")
    assert [r.n for r in logs.read_log(spark, path, kind).collect()] == [1]
    logs.compact(spark, path, kind)
    logs.remove_folded(spark, path)
    assert [r.n for r in logs.read_log(spark, path, kind).collect()] == [1]
