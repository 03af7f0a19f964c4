from datetime import timedelta

import pytest
from pyspark.sql import functions as F

from tests.helpers import T0, batch, frame, minutes, realtime, same
from tidemark import schemas as S
from tidemark.operators import quality, registry, serving
from tidemark.sources import logs


def _rt(spark, *rows):
    return frame(spark, rows, S.REALTIME)


def _bt(spark, *rows):
    return frame(spark, rows, S.BATCH)


def test_write_then_read(spark, tmp_path):
    path = str(tmp_path)
    assert serving.upsert(_rt(spark, realtime()), "realtime", path, 0, T0) == 1
    row = serving.live(serving.read_serving(spark, path, "realtime"), T0).first().asDict()
    assert {n: row[n] for n in S.REALTIME.names} == realtime()


def test_nothing_written_yet(spark, tmp_path):
    rows = serving.read_serving(spark, str(tmp_path), "realtime")
    assert rows.count() == 0 and serving.live(rows, T0).count() == 0
    empty = serving.feature_vectors(
        serving.live(rows, T0), serving.live(serving.read_serving(spark, str(tmp_path), "batch"), T0), T0
    )
    assert empty.count() == 0


def test_lifetimes(spark):
    rt = serving.serving_rows(_rt(spark, realtime()), "realtime", T0).first()
    bt = serving.serving_rows(_bt(spark, batch()), "batch", T0).first()
    assert rt.expires_at - rt.written_at == timedelta(seconds=3600)
    assert bt.expires_at - bt.written_at == timedelta(seconds=129600)
    rows = serving.serving_rows(_rt(spark, realtime()), "realtime", T0)
    assert serving.live(rows, T0 + timedelta(seconds=3599)).count() == 1
    assert serving.live(rows, T0 + timedelta(seconds=3600)).count() == 0
    assert serving.live(rows, T0 - timedelta(seconds=1)).count() == 0


def test_overwrite_wins_and_replay_changes_nothing(spark, tmp_path):
    path = str(tmp_path)
    serving.upsert(_rt(spark, realtime()), "realtime", path, 0, T0)
    update = _rt(spark, realtime(txn_count_1h=41, txn_amount_sum_1h=0.75))
    for _ in range(2):
        serving.upsert(update, "realtime", path, 1, minutes(1))
    rows = serving.read_serving(spark, path, "realtime")
    assert rows.count() == 2
    row = serving.live(rows, minutes(2)).first()
    assert (row.txn_count_1h, row.txn_amount_sum_1h) == (41, 0.75)
    serving.compact_serving(spark, path, "realtime", minutes(2))
    assert serving.read_serving(spark, path, "realtime").count() == 1


def test_vector_full_one_sided_and_missing(spark):
    rt = _rt(spark, realtime("both"), realtime("hot"))
    bt = _bt(spark, batch("both"), batch("cold"))
    got = {r.account_id: r for r in serving.feature_vectors(rt, bt, minutes(5)).collect()}
    assert set(got) == {"both", "hot", "cold"}
    assert got["both"].realtime.asDict() == realtime("both")
    assert got["both"].batch.asDict() == batch("both")
    assert got["hot"].batch.asDict() == {
        "account_id": "hot",
        "computed_at": minutes(5),
        **S.BATCH_DEFAULTS,
    }
    assert got["cold"].realtime.asDict() == {
        "account_id": "cold",
        "computed_at": minutes(5),
        "distance_from_home": None,
        **S.REALTIME_DEFAULTS,
    }
    assert got["both"].served_at == minutes(5) and got["both"].feature_store_version == "1.0.0"


def test_model_input_is_flat(spark):
    vectors = serving.feature_vectors(_rt(spark, realtime()), _bt(spark, batch()), T0)
    flat = serving.model_input(vectors)
    assert "computed_at" not in flat.columns
    assert set(flat.columns) == {"account_id", *S.REALTIME_FEATURES, *S.BATCH_FEATURES}
    assert all(kind in ("bigint", "double", "boolean", "int", "string") for _, kind in flat.dtypes)


def test_bulk(spark, tmp_path):
    rows = [batch(f"n{i}", avg_txn_amount_30d=i / 4) for i in range(37)]
    assert serving.upsert(_bt(spark, *rows), "batch", str(tmp_path), 1, T0) == 37
    live = serving.live(serving.read_serving(spark, str(tmp_path), "batch"), T0)
    assert {r.account_id: r.avg_txn_amount_30d for r in live.collect()} == {
        f"n{i}": i / 4 for i in range(37)
    }
    assert serving.upsert(_bt(spark, *rows).where("false"), "batch", str(tmp_path), 2, T0) == 0


def test_deletion(spark, tmp_path):
    rows = serving.serving_rows(_rt(spark, realtime("a"), realtime("b")), "realtime", T0)
    gone = spark.createDataFrame([("a",), ("a",)], "account_id string")
    assert [r.account_id for r in serving.delete_accounts(rows, gone).collect()] == ["b"]
    marks = gone.withColumn("deleted_at", F.lit(str(minutes(1))).cast("timestamp_ntz"))
    assert [r.account_id for r in serving.live(rows, minutes(2), marks).collect()] == ["b"]
    again = rows.unionByName(
        serving.serving_rows(_rt(spark, realtime("a")), "realtime", minutes(5), batch_id=1)
    )
    assert serving.live(again, minutes(6), marks).count() == 2
    path = str(tmp_path)
    serving.upsert(_rt(spark, realtime("a"), realtime("b")), "realtime", path, 0, T0)
    serving.mark_deleted(gone, path, 0, minutes(1))
    stored = serving.read_tombstones(spark, path)
    assert serving.live(serving.read_serving(spark, path, "realtime"), minutes(2), stored).count() == 1
    serving.compact_serving(spark, path, "realtime", minutes(2), stored)
    assert [r.account_id for r in serving.read_serving(spark, path, "realtime").collect()] == ["b"]
    assert logs.remove_folded(spark, f"{path}/realtime") == 1
    files = list(tmp_path.joinpath("realtime").rglob("part-*.parquet"))
    accounts = {
        r.account_id
        for f in files
        for r in spark.read.parquet(str(f)).collect()
        if "account_id" in r.asDict()
    }
    assert accounts == {"b"}
    assert [r.account_id for r in serving.read_serving(spark, path, "realtime").collect()] == ["b"]


def _counts(spark, path, at):
    rows = serving.live(serving.read_serving(spark, path, "realtime"), at).collect()
    return {r.account_id: r.txn_count_1h for r in rows}


def _put(spark, path, account, n, batch_id, at, stream="main"):
    rows = _rt(spark, realtime(account, txn_count_1h=n))
    serving.upsert(rows, "realtime", path, batch_id, at, stream=stream)


def test_low_batch_ids_are_seen_after_compaction(spark, tmp_path):
    path = str(tmp_path)
    _put(spark, path, "a", 1, 10, T0)
    serving.compact_serving(spark, path, "realtime", T0)
    _put(spark, path, "b", 2, 5, minutes(1))
    assert _counts(spark, path, minutes(2)) == {"a": 1, "b": 2}
    serving.compact_serving(spark, path, "realtime", minutes(2))
    assert _counts(spark, path, minutes(2)) == {"a": 1, "b": 2}


def test_a_rerun_after_compaction_replaces_its_batch(spark, tmp_path):
    path = str(tmp_path)
    _put(spark, path, "a", 1, 3, T0)
    _put(spark, path, "b", 1, 4, T0)
    serving.compact_serving(spark, path, "realtime", T0)
    for _ in range(2):
        _put(spark, path, "a", 9, 3, T0)
        assert _counts(spark, path, T0) == {"a": 9, "b": 1}
        serving.compact_serving(spark, path, "realtime", T0)
        assert _counts(spark, path, T0) == {"a": 9, "b": 1}
    logs.remove_folded(spark, f"{path}/realtime")
    assert _counts(spark, path, T0) == {"a": 9, "b": 1}


def test_a_new_stream_replaces_nothing_of_the_old(spark, tmp_path):
    path = str(tmp_path)
    _put(spark, path, "a", 1, 0, T0)
    _put(spark, path, "b", 2, 0, minutes(1), stream="second")
    assert _counts(spark, path, minutes(2)) == {"a": 1, "b": 2}


def test_rows_written_later_survive_compaction(spark, tmp_path):
    path = str(tmp_path)
    _put(spark, path, "a", 1, 0, T0)
    _put(spark, path, "a", 2, 1, minutes(2))
    serving.compact_serving(spark, path, "realtime", minutes(1))
    assert _counts(spark, path, minutes(1)) == {"a": 1}
    assert _counts(spark, path, minutes(3)) == {"a": 2}


def test_an_unreadable_log_raises(spark, tmp_path):
    batch = tmp_path / "realtime" / "log" / "stream=main" / "batch_id=0"
    batch.mkdir(parents=True)
    (batch / "part-0.parquet").write_bytes(b"no rows")
    with pytest.raises(Exception):
        serving.read_serving(spark, str(tmp_path), "realtime").count()


@pytest.mark.parametrize("group", ["realtime", "batch"])
def test_json_round_trip(spark, group):
    rows = _rt(spark, realtime(distance_from_home=None)) if group == "realtime" else _bt(spark, batch())
    pairs = serving.key_values(rows, group, "own:prefix")
    row = pairs.first()
    assert row.key == f"own:prefix:north:{group}"
    assert row.ttl_seconds == (3600 if group == "realtime" else 129600)
    assert same(rows, serving.from_key_values(pairs, group))


def test_registry(spark):
    assert registry.registry_frame(spark, complete=False).count() == 16
    assert registry.registry_frame(spark).count() == 23
    hot = registry.features_by_path(spark, "hot", complete=False)
    cold = registry.features_by_path(spark, "cold", complete=False)
    assert (hot.count(), cold.count()) == (8, 8)
    tagged = registry.features_by_tag(spark, "fraud-signal").orderBy("position")
    assert [r.name for r in tagged.collect()] == [
        "txn_count_1h",
        "txn_velocity_5m",
        "distance_from_home",
        "is_new_merchant",
        "txn_amount_p95_90d",
    ]
    assert registry.features_by_tag(spark, "no-such-tag").count() == 0


def test_schema_report_and_selection(spark):
    vectors = serving.feature_vectors(_rt(spark, realtime()), _bt(spark, batch()), T0)
    flat = serving.model_input(vectors)
    report = registry.schema_report(flat)
    assert {r.status for r in report.collect()} == {"ok"}
    broken = flat.drop("txn_count_1h").withColumn("is_weekend", F.lit("no"))
    bad = {r.name: r.status for r in registry.schema_report(broken).collect() if r.status != "ok"}
    assert bad == {"txn_count_1h": "missing", "is_weekend": "type"}
    assert registry.select_features(flat, path="cold").columns == [
        "account_id",
        *registry.feature_names(path="cold"),
    ]


def test_quality_gate(spark):
    def status(n, written, **over):
        rows = frame(spark, [batch(f"a{i}", **over) for i in range(n)], S.BATCH)
        return {r.check_name: r.status for r in quality.quality_gate(rows, written).collect()}

    assert status(100, 95) == {
        "min_accounts": "pass",
        "written_ratio": "pass",
        "values_in_range": "pass",
    }
    assert status(99, 99)["min_accounts"] == "warn"
    assert status(100, 94)["written_ratio"] == "fail"
    assert status(3, 3, pct_online_txns_30d=1.5)["values_in_range"] == "fail"
    assert status(0, 0)["min_accounts"] == "warn"


def test_freshness(spark):
    rows = _rt(spark, realtime("a"), realtime("b", minutes(-2)))
    assert {r.account_id: r.age_seconds for r in quality.freshness(rows, minutes(1)).collect()} == {
        "a": 60.0,
        "b": 180.0,
    }


def test_skew_report(spark):
    hot = _rt(spark, realtime("a", txn_count_1h=3), realtime("b", country_code="US"), realtime("c"))
    cold = _rt(spark, realtime("a", txn_count_1h=5), realtime("b", country_code="CA"),
               realtime("c", txn_amount_sum_1h=realtime()["txn_amount_sum_1h"] + 0.001))
    names = ["txn_count_1h", "country_code", "txn_amount_sum_1h", "is_weekend"]
    rows = quality.skew_report(hot, cold, names, tolerance=0.01).collect()
    got = {(r.account_id, r.feature): (r.hot_value, r.cold_value, r.gap) for r in rows}
    assert got == {
        ("a", "txn_count_1h"): ("3", "5", 2.0),
        ("b", "country_code"): ("US", "CA", None),
    }
