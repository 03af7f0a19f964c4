import json
from datetime import timedelta

import pytest
from pyspark.sql import functions as F

from tests.helpers import T0, event, frame, messages, minutes, txn
from tidemark import schemas as S
from tidemark.operators import serving, validation
from tidemark.plans import delivery_queries, sql_surface
from tidemark.session import stream_session
from tidemark.sources import bucketed
from tidemark.streaming import ingest, ledger, panes, progress

ONCE = {"availableNow": True}
DAY = timedelta(days=1)


# The ledger.


def kept(spark, path):
    rows = ledger.read_events(spark, path, S.TRANSACTION).collect()
    return sorted((r.event_id, str(r.transaction_date), r.stream, r.batch_id) for r in rows)


def test_an_event_is_kept_once_whenever_it_comes_again(spark, tmp_path):
    path = str(tmp_path / "events")
    assert kept(spark, path) == []
    first = [txn("a"), txn("a"), txn("b", at=T0 + DAY)]
    ledger.append_new(frame(spark, first), path, 0, "main")
    ledger.append_new(frame(spark, [txn("a"), txn("c", at=T0 + DAY)]), path, 1, "main")
    # Much later, under a new checkpoint that counts its batches from 0.
    ledger.append_new(frame(spark, [*first, txn("d", at=T0 + 40 * DAY)]), path, 0, "again")
    want = [
        ("a", "2024-01-15", "main", 0),
        ("b", "2024-01-16", "main", 0),
        ("c", "2024-01-16", "main", 1),
        ("d", "2024-02-24", "again", 0),
    ]
    assert kept(spark, path) == want
    # A batch that runs again replaces its rows and doesn't stumble over them.
    ledger.append_new(frame(spark, [txn("a"), txn("c", at=T0 + DAY)]), path, 1, "main")
    ledger.append_new(frame(spark, first), path, 0, "main")
    assert kept(spark, path) == want
    ledger.append_new(frame(spark, []), path, 2, "main")
    assert kept(spark, path) == want
    found = ledger.find_events(spark, path, S.TRANSACTION, ["c", "nowhere"]).collect()
    assert [r.event_id for r in found] == ["c"]


def test_repeats_in_a_batch_leave_one_row_whatever_their_order(spark, tmp_path):
    rows = [txn("a", amount=float(k), at=minutes(k % 3)) for k in range(12)]
    seen = set()
    for k, order in enumerate((rows, rows[::-1])):
        path = str(tmp_path / f"events{k}")
        ledger.append_new(frame(spark, order).repartition(3), path, 0, "main")
        (row,) = ledger.read_events(spark, path, S.TRANSACTION).collect()
        seen.add((row.amount, row.event_timestamp))
    assert len(seen) == 1 and seen.pop()[1] == T0


def test_only_the_days_of_a_batch_are_read(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "events")
    rows = [txn(f"e{k}", at=T0 + k * DAY) for k in range(6)]
    ledger.append_new(frame(spark, rows), path, 0, "main")
    stored = ledger.read_events(spark, path, S.TRANSACTION)
    known = stored.where(F.col("transaction_date").between("2024-01-17", "2024-01-18")).select("event_id")
    plan = known._jdf.queryExecution().executedPlan().toString()
    scan = plan[plan.index("FileScan") :]
    assert "transaction_date" in scan[scan.index("PartitionFilters") :][:200]
    assert "ReadSchema: struct<event_id:string>" in scan


def test_a_stream_replayed_under_a_new_checkpoint(spark, tmp_path):
    session = stream_session(spark, 2)
    source, path = str(tmp_path / "in"), str(tmp_path / "events")
    for k in range(3):
        frame(session, [txn(f"e{k}", at=minutes(k)), txn("all", at=T0)]).coalesce(1).write.mode("append").parquet(source)
    for name in ("one", "two"):
        events = session.readStream.schema(S.TRANSACTION).option("maxFilesPerTrigger", 1).parquet(source)
        ledger.write_once(events, path, str(tmp_path / name), name, ONCE).awaitTermination()
    assert [(r[0], r[2]) for r in kept(session, path)] == [("all", "one"), ("e0", "one"), ("e1", "one"), ("e2", "one")]


# Progress.


def test_progress_is_stored_and_adds_up(spark, tmp_path):
    session = stream_session(spark, 2)
    source, root = str(tmp_path / "in"), str(tmp_path)
    with progress.recorded(session, f"{root}/progress") as runs:
        for rows in (
            [txn("e1", at=minutes(60)), txn("e2", at=minutes(61))],
            [txn("late", at=minutes(1)), txn("later", at=minutes(2)), txn("e3", at=minutes(62))],
        ):
            frame(session, rows).coalesce(1).write.mode("append").parquet(source)
            running = ingest.process_stream(
                panes.pane_stream(session.readStream.schema(S.TRANSACTION).parquet(source), dedupe=True),
                lambda batch, batch_id: panes.write_panes(batch, f"{root}/panes", batch_id),
                f"{root}/ck",
                ONCE,
                "update",
            )
            running.awaitTermination()
            runs.append(str(running.runId))
    told = progress.read_progress(session, f"{root}/progress")
    accepted = panes.read_panes(session, f"{root}/panes").agg(F.sum("n").alias("accepted"))
    row = progress.delivery_report(told, accepted).first()
    assert (row.delivered, row.late, row.accepted, row.complete) == (5, 2, 3, True)
    assert told.groupBy("query_id", "batch_id").count().where("count > 1").isEmpty()
    first = told.orderBy("batch_id").first()
    assert first.state_rows > 0 and first.trigger_ms > 0 and first.triggered_at is not None
    assert progress.read_progress(session, f"{root}/none").isEmpty()


def test_a_lost_end_is_an_error(spark, tmp_path):
    with pytest.raises(TimeoutError, match="never"):
        with progress.recorded(spark, str(tmp_path / "p"), seconds=0.1) as runs:
            runs.append("never")


# Null against absent.


def strict(spark, values):
    decoded = validation.decode_messages(messages(spark, values), strict_nulls=True)
    return decoded, [list(r.errors) for r in validation.validate(decoded).orderBy("offset").collect()]


def test_an_explicit_null_breaks_a_field_with_a_default(spark):
    values = [
        event(),
        event(merchant_category=None),
        event(is_online=None, card_present=None, country_code=None),
        event(latitude=None, longitude=None),  # these may be null
        event(merchant_category="null", country_code="US"),
        "{oops",
        None,
        event(amount=None, merchant_category=None),
    ]
    decoded, errors = strict(spark, values)
    assert errors == [
        [],
        ["merchant_category"],
        ["is_online", "card_present", "country_code"],
        [],
        [],
        ["malformed"],
        ["malformed"],
        ["amount", "merchant_category"],
    ]
    valid, dead = validation.split_valid(decoded, "2024-01-01 00:00:00")
    assert sorted(r.merchant_category for r in valid.collect()) == ["null", "unknown", "unknown"]
    assert "_nulls" not in valid.columns and dead.count() == 5
    lenient = validation.validate(validation.decode_messages(messages(spark, values)))
    assert sum(r.errors == [] for r in lenient.collect()) == 5


def test_metadata_holds_any_json(spark, tmp_path):
    raw = messages(spark, [event(amount=-1)])
    bad = validation.check(validation.decode_messages(raw))
    about = F.parse_json(F.lit(json.dumps({"host": "h1", "tries": [1, 2], "more": {"x": None}})))
    path = str(tmp_path / "dead")
    validation.envelope(bad, validation.error_reason(), "2024-01-01 00:00:00", metadata=about).write.parquet(path)
    stored = spark.read.parquet(path)
    row = stored.select(
        F.variant_get("metadata", "$.tries[1]", "int").alias("second"),
        F.is_variant_null(F.variant_get("metadata", "$.more.x", "variant")).alias("nothing"),
    ).first()
    assert (row.second, row.nothing) == (2, True)
    assert [r.errors for r in validation.redrive(stored).collect()] == [["amount"]]


# Stored surfaces.


def test_sql_objects_follow_what_is_stored(spark, tmp_path):
    session = spark.newSession()
    rows = [
        (a, f"2024-01-0{d} 00:00:00", f"2024-01-0{d} 00:00:10", d) for a in ("x", "y") for d in (1, 3, 5)
    ]
    given = session.createDataFrame(rows, "account_id string, computed_at string, committed_at string, snapshot_id long")
    snaps = given.select(
        *[
            (
                F.col(f.name).cast(f.dataType)
                if f.name in given.columns
                else F.lit(None).cast(f.dataType)
            ).alias(f.name)
            for f in [*S.REALTIME.fields, *panes.SNAPSHOT.fields[-2:]]
        ]
    )
    snaps.write.parquet(str(tmp_path / "snaps"))
    daily = session.createDataFrame([("x", "2024-01-01"), ("x", "2024-01-02"), ("y", "2024-01-01")], "account_id string, d string")
    daily.select("account_id", F.col("d").cast("date").alias("computation_date")).write.partitionBy(
        "computation_date"
    ).parquet(str(tmp_path / "daily"))
    sql_surface.register(
        session, session.read.parquet(str(tmp_path / "daily")), session.read.parquet(str(tmp_path / "snaps"))
    )

    def ask(text):
        return sorted(tuple(r) for r in session.sql(text).collect())

    assert ask("SELECT account_id FROM latest_account_features") == [("x",)]
    assert len(ask("SELECT account_id, computation_date FROM account_features")) == 3
    moment = "TIMESTAMP_NTZ '2024-01-03 00:00:10'"
    assert ask(f"SELECT account_id, snapshot_id FROM features_as_of({moment})") == [("x", 3), ("y", 3)]
    assert ask("SELECT account_id FROM features_as_of(TIMESTAMP_NTZ '2023-01-01 00:00:00')") == []
    history = "account_history('y', TIMESTAMP_NTZ '2024-01-02 00:00:00', TIMESTAMP_NTZ '2024-01-05 00:00:00')"
    assert ask(f"SELECT snapshot_id FROM {history}") == [(3,), (5,)]
    # The account's name reaches the scan, and only asked columns are read.
    plan = session.sql(f"SELECT snapshot_id FROM {history}")._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(account_id,y)" in plan and "txn_count_1h" not in plan[plan.index("ReadSchema") :]


def test_a_vector_from_buckets_moves_nothing(spark, folder):
    vectors = delivery_queries.stored_vector(spark, folder)
    plan = vectors._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "SelectedBucketsCount: 8 out of 8" in plan
    assert vectors.count() == 15


def test_buckets_are_one_file_each(spark, tmp_path):
    df = spark.range(1000).selectExpr("concat('a', id % 100) AS account_id", "id").repartition(7)
    bucketed.write_bucketed(df, "bucket_test", str(tmp_path / "b"), buckets=4)
    stored = bucketed.read_bucketed(spark, "bucket_test")
    assert len(stored.inputFiles()) == 4 and stored.count() == 1000
    joined = serving.delete_accounts(stored, stored.where("id < 5"))
    assert joined.count() == 950
