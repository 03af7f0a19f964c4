import json
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tests.helpers import T0, event, frame, messages, minutes, same, txn
from tidemark import schemas as S
from tidemark.operators import hopping, serving, trailing
from tidemark.operators.quality import EXHAUSTED
from tidemark.sources import logs, tables
from tidemark.streaming import ingest, panes, visits

ONCE = {"availableNow": True}
MESSAGE = "key string, value string, topic string, partition int, offset bigint"


def _write_parts(df, path, cuts):
    """Time-ordered files, one per micro-batch."""
    for low, high in zip(cuts, cuts[1:]):
        part = df.where(F.col("event_timestamp").between(low, high - timedelta(microseconds=1)))
        part.coalesce(1).write.mode("append").parquet(path)


def _stream(spark, path, schema):
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(path)


def _stored(batch, path):
    """The batch as a plain table, to be handed on more than once."""
    batch.write.parquet(path)
    return batch.sparkSession.read.parquet(path)


@pytest.fixture
def parts(spark, folder, tmp_path):
    txns = tables.transactions(spark, folder).withColumn(
        "merchant_category", F.coalesce("merchant_category", F.lit("unknown"))
    )
    path = str(tmp_path / "in")
    _write_parts(txns, path, [datetime(2024, 1, d) for d in (1, 8, 15, 22, 31)])
    return txns, path, str(tmp_path)


def test_streamed_panes_equal_batch_panes_even_when_replayed(spark, parts):
    txns, path, root = parts

    def twice(batch, batch_id):
        stored = _stored(batch, f"{root}/stored-{batch_id}")
        for _ in range(2):
            panes.write_panes(stored, f"{root}/panes", batch_id)

    ingest.process_stream(
        panes.pane_stream(_stream(spark, path, S.TRANSACTION)), twice, f"{root}/ck", ONCE, "update"
    ).awaitTermination()
    streamed = hopping.windows_over(panes.read_panes(spark, f"{root}/panes")).drop("pane_end")
    assert spark.read.parquet(f"{root}/panes").select("batch_id").distinct().count() >= 4
    assert same(streamed, hopping.hop_features(txns))


def test_hot_path_end_to_end(spark, parts, folder):
    txns, path, root = parts
    profiles = tables.profiles(spark, folder)
    paths = panes.Paths.under(root)
    visits.write_flagged(
        _stream(spark, path, S.TRANSACTION), f"{root}/flagged", f"{root}/ck-v", ONCE
    ).awaitTermination()
    flagged = visits.stream_flagged(spark, f"{root}/flagged", S.TRANSACTION)
    clock = lambda: datetime(2024, 1, 31)
    sink = panes.make_sink(paths, profiles, clock)

    def replayed(batch, batch_id):
        stored = _stored(batch, f"{root}/stored-{batch_id}")
        sink(stored, batch_id)
        sink(stored, batch_id)

    ingest.process_stream(
        panes.pane_stream(flagged, flagged=True), replayed, f"{root}/ck", ONCE, "update"
    ).awaitTermination()

    live = serving.newest(serving.read_serving(spark, paths.serving, "realtime"))
    # The exact per-event features agree on everything that does not depend on window alignment.
    events = trailing.trailing_features(txns, profiles)
    newest = events.groupBy("account_id").agg(
        F.max_by(F.struct(*events.columns), F.struct("computed_at", "event_id")).alias("v")
    ).select("v.*")
    shared = ["account_id", "distance_from_home", "is_new_merchant", "hour_of_day", "is_weekend"]
    assert same(live.select(*shared), newest.select(*shared))
    hops = hopping.hop_features(txns)
    last = hops.groupBy("account_id").agg(F.max_by(F.struct(*hops.columns), "window_end").alias("v"))
    sums = ["account_id", "txn_count_1h", "txn_amount_sum_1h", "txn_amount_max_1h"]
    assert same(live.select(*sums), last.select("v.*").select(*sums))

    snaps = logs.read_log(spark, paths.snapshots, panes.SNAPSHOT)
    served = serving.read_serving(spark, paths.serving, "realtime")
    assert snaps.count() == served.count() >= 15
    runs = logs.read_log(spark, paths.runs, panes.RUN).collect()
    assert sum(r.features_written for r in runs) == served.count()
    assert {r.snapshot_error for r in runs} == {None}


def test_snapshot_failure_does_not_stop_serving(spark, tmp_path):
    paths = panes.Paths.under(str(tmp_path))
    (tmp_path / S.REALTIME_SNAPSHOTS).write_text("a file where the folder should be")
    rows = hopping.panes(frame(spark, [txn("e1"), txn("e2", at=minutes(1))]))
    timed = rows.withColumn(
        "newest",
        F.col("newest").withField("event_timestamp", F.col("newest.event_timestamp").cast("timestamp")),
    )
    panes.make_sink(paths, clock=lambda: T0)(timed, 0)
    assert serving.read_serving(spark, paths.serving, "realtime").count() == 1
    run = logs.read_log(spark, paths.runs, panes.RUN).first()
    assert run.features_written == 1 and run.snapshot_error


def test_empty_batch_is_a_no_op(spark, tmp_path):
    paths = panes.Paths.under(str(tmp_path))
    empty = spark.createDataFrame([], panes.PANE).drop("written_us", "pane_block", "stream", "batch_id")
    panes.make_sink(paths)(empty, 0)
    assert not (tmp_path / "serving").exists()


def test_late_rows_are_dropped_and_counted(spark, tmp_path):
    path = str(tmp_path / "in")
    for rows in (
        [txn("e1", at=minutes(0)), txn("e2", at=minutes(10))],
        [txn("e3", at=minutes(20))],
        [txn("late", at=minutes(1)), txn("e4", at=minutes(21))],
    ):
        frame(spark, rows).coalesce(1).write.mode("append").parquet(path)
        # Files are taken in order of their modification time.
        import time

        time.sleep(1.1)
    query = ingest.process_stream(
        panes.pane_stream(_stream(spark, path, S.TRANSACTION)),
        lambda batch, i: panes.write_panes(batch, str(tmp_path / "panes"), i),
        str(tmp_path / "ck"),
        ONCE,
        "update",
    )
    query.awaitTermination()
    dropped = sum(
        op["numRowsDroppedByWatermark"] for p in query.recentProgress for op in p["stateOperators"]
    )
    assert dropped == 1
    assert panes.read_panes(spark, str(tmp_path / "panes")).count() == 4


def test_repeats_are_dropped_within_the_watermark(spark, tmp_path):
    path = str(tmp_path / "in")
    rows = [txn("e1"), txn("e1"), txn("e2", at=minutes(1)), txn("e2", at=minutes(1))]
    frame(spark, rows).coalesce(1).write.parquet(path)
    out = str(tmp_path / "out")
    (
        panes.dedupe_stream(_stream(spark, path, S.TRANSACTION))
        .writeStream.format("parquet")
        .option("checkpointLocation", str(tmp_path / "ck"))
        .trigger(**ONCE)
        .start(out)
        .awaitTermination()
    )
    assert sorted(r.event_id for r in spark.read.parquet(out).collect()) == ["e1", "e2"]


def test_panes_count_a_repeated_event_once(spark, tmp_path):
    path = str(tmp_path / "in")
    rows = [txn("e1"), txn("e1"), txn("e2"), txn("e3", at=minutes(1)), txn("e3", at=minutes(1))]
    frame(spark, rows).coalesce(1).write.parquet(path)
    out = str(tmp_path / "panes")
    ingest.process_stream(
        panes.pane_stream(_stream(spark, path, S.TRANSACTION), dedupe=True),
        lambda batch, i: panes.write_panes(batch, out, i),
        str(tmp_path / "ck"),
        ONCE,
        "update",
    ).awaitTermination()
    got = {r.pane_end: r.n for r in panes.read_panes(spark, out).collect()}
    assert sorted(got.values()) == [1, 2]


def test_bad_messages_do_not_stop_the_stream(spark, tmp_path):
    path = str(tmp_path / "in")
    values = [event(event_id=f"e{i}") for i in range(5)] + [event(amount=-1), "{oops", None]
    messages(spark, values).coalesce(2).write.parquet(path)
    checked = str(tmp_path / "checked")
    ingest.write_checked(
        _stream(spark, path, MESSAGE), checked, str(tmp_path / "ck"), ONCE
    ).awaitTermination()
    rows = ingest.read_checked(spark, checked)
    assert ingest.valid_events(rows).count() == 5
    reasons = sorted(r.error_reason for r in ingest.dead_letters(rows).collect())
    assert reasons == [
        "Validation error: amount",
        "Validation error: malformed",
        "Validation error: malformed",
    ]
    again = ingest.stream_checked(spark, checked, max_files=10)
    assert again.isStreaming and ingest.valid_events(again).isStreaming


def test_retries_then_only_the_bad_message_is_set_aside(spark, tmp_path):
    calls, kept = [], {}

    def flaky(batch, batch_id):
        calls.append(batch_id)
        names = {json.loads(r.value)["event_id"] for r in batch.collect()}
        if len(calls) < 2 or "bad" in names:
            raise RuntimeError("no luck")
        kept[batch_id] = names

    path = str(tmp_path / "dead")
    run = ingest.with_retries(flaky, path, max_retries=3, delay_seconds=0.0)
    good = [event(event_id=f"e{i}") for i in range(9)]
    run(messages(spark, good), 0)
    assert calls == [0, 0] and kept[0] == {f"e{i}" for i in range(9)}
    df = messages(spark, [*good, event(event_id="bad")])
    run(df, 1)
    assert kept[1] == {f"e{i}" for i in range(9)}
    dead = spark.read.parquet(f"{path}/log")
    assert dead.count() == 1
    row = dead.first()
    assert row.error_reason == EXHAUSTED and row.metadata == {"error": "RuntimeError: no luck"}
    assert json.loads(row.original_message)["event_id"] == "bad"
    from tidemark.operators.quality import ingest_stats

    stats = ingest_stats(df.where("offset < 0"), dead).first()
    assert (stats.processed, stats.failed, stats.dlq_routed) == (0, 1, 1)


def test_every_good_message_is_processed_beside_several_bad_ones(spark, tmp_path):
    kept = {}

    def handler(batch, batch_id):
        names = {json.loads(r.value)["event_id"] for r in batch.collect()}
        if any(n.startswith("bad") for n in names):
            raise RuntimeError("no luck")
        kept[batch_id] = names

    path = str(tmp_path / "dead")
    run = ingest.with_retries(handler, path, max_retries=2, delay_seconds=0.0)
    good = {f"e{i}" for i in range(190)}
    bad = {f"bad{i}" for i in range(10)}
    run(messages(spark, [event(event_id=n) for n in sorted(good | bad)]).coalesce(1), 0)
    dead = [json.loads(r.original_message)["event_id"] for r in spark.read.parquet(f"{path}/log").collect()]
    assert kept[0] == good and sorted(dead) == sorted(bad)


def test_a_batch_that_fails_only_for_a_while_is_kept_whole(spark, tmp_path):
    calls, kept = [], {}

    def handler(batch, batch_id):
        calls.append(batch_id)
        if len(calls) <= 2:
            raise RuntimeError("not yet")
        kept[batch_id] = {json.loads(r.value)["event_id"] for r in batch.collect()}

    run = ingest.with_retries(handler, str(tmp_path / "dead"), max_retries=2, delay_seconds=0.0)
    run(messages(spark, [event(event_id=f"e{i}") for i in range(9)]), 0)
    assert kept[0] == {f"e{i}" for i in range(9)}


def test_first_visits_are_the_earliest_in_any_order(spark, tmp_path):
    path, out, ck = (str(tmp_path / n) for n in ("in", "out", "ck"))
    rows = [txn(f"e{m}", at=minutes(m)) for m in (9, 4, 7)]
    frame(spark, rows).coalesce(1).write.mode("append").parquet(path)
    ingest.write_first_visits(_stream(spark, path, S.TRANSACTION), out, ck, ONCE).awaitTermination()
    assert ingest.read_first_visits(spark, out).first().event_id == "e4"
    frame(spark, [txn("e1", at=minutes(1))]).coalesce(1).write.mode("append").parquet(path)
    ingest.write_first_visits(_stream(spark, path, S.TRANSACTION), out, ck, ONCE).awaitTermination()
    assert ingest.read_first_visits(spark, out).first().event_id == "e1"
    logs.compact(spark, out, ingest.VISIT, ingest.earliest_visits)
    assert [r.event_id for r in ingest.read_first_visits(spark, out).collect()] == ["e1"]


def test_a_trigger_lists_only_the_hours_it_needs(spark, tmp_path):
    path = str(tmp_path / "panes")
    for batch_id in range(6):
        rows = hopping.panes(frame(spark, [txn(f"e{batch_id}", at=T0 + timedelta(hours=7 * batch_id))]))
        timed = rows.withColumn(
            "newest",
            F.col("newest").withField(
                "event_timestamp", F.col("newest.event_timestamp").cast("timestamp")
            ),
        )
        span = panes.write_panes(timed, path, batch_id)
    blocks = panes._blocks(span["first"] - 3600, span["last"])
    assert len(blocks) <= 2 and len(panes.stored_panes(spark, path, blocks).inputFiles()) <= 2
    assert panes.newest_windows(spark, path, 5, span).count() == 1
    panes.fold_panes(spark, path, str(tmp_path / "folded"), range(0, blocks[-1]))
    assert spark.read.parquet(str(tmp_path / "folded")).count() == 5


def test_first_visits_survive_a_restart(spark, tmp_path):
    path, out, ck = (str(tmp_path / n) for n in ("in", "out", "ck"))
    frame(spark, [txn("e1"), txn("e2", merchant="n")]).coalesce(1).write.mode("append").parquet(path)
    ingest.write_first_visits(_stream(spark, path, S.TRANSACTION), out, ck, ONCE).awaitTermination()
    more = [txn("e3", at=minutes(5)), txn("e4", account="b", at=minutes(5))]
    frame(spark, more).coalesce(1).write.mode("append").parquet(path)
    ingest.write_first_visits(_stream(spark, path, S.TRANSACTION), out, ck, ONCE).awaitTermination()
    rows = ingest.read_first_visits(spark, out)
    assert sorted(r.event_id for r in rows.collect()) == ["e1", "e2", "e4"]
    assert ingest.read_first_visits(spark, out, "2024-01-16").count() == 0


def test_a_cap_stops_the_stream_after_a_whole_batch(spark, tmp_path):
    path = str(tmp_path / "in")
    for part in range(4):
        rows = messages(spark, [event(event_id=f"e{part}{i}") for i in range(3)])
        rows.coalesce(1).write.mode("append").parquet(path)
    query = ingest.write_checked(
        _stream(spark, path, MESSAGE),
        str(tmp_path / "out"),
        str(tmp_path / "ck"),
        {"processingTime": "2 seconds"},
    )
    taken = ingest.stop_after(query, 4, poll_seconds=0.1)
    assert taken >= 6 and taken % 3 == 0 and not query.isActive
