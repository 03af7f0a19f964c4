"""Queries about delivery (replays, late rows, caps, failing sinks, nulls) and about stored surfaces."""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark import schemas as S
from tidemark.operators import daily, hopping, registry, serving, staging, trailing, validation
from tidemark.plans import queries as q
from tidemark.plans import sql_surface
from tidemark.plans.queries import query
from tidemark.session import run_dir, stream_session
from tidemark.sources import bucketed, tables
from tidemark.sources.feature_tables import write_daily
from tidemark.sources.logs import read_log
from tidemark.streaming import ingest, ledger, panes, progress

EARLIER_DATES = ("2024-01-20", "2024-01-29")


@query
def replayed_once(spark: SparkSession, folder: str) -> DataFrame:
    """All messages, delivered a second time under a new checkpoint long after the watermark."""
    spark = stream_session(spark)
    root = run_dir(spark, "ledger")
    messages = tables.messages_from(q._event_stream(spark, folder))
    events = ingest.valid_events(ingest.checked_rows(messages))
    for delivery in ("first", "second"):
        ledger.write_once(
            events, f"{root}/events", f"{root}/ck-{delivery}", delivery, q._ONCE
        ).awaitTermination()
    stored = ledger.read_events(spark, f"{root}/events", events.schema)
    return stored.select("event_id", "account_id", "event_timestamp", "amount", "stream")


@query
def stream_progress(spark: SparkSession, folder: str) -> DataFrame:
    """The first half of the month arrives after the second; what was delivered adds up."""
    spark = stream_session(spark)
    root = run_dir(spark, "progress")
    rows = q._staged(spark, folder)
    early = F.col("event_timestamp") < F.lit(q.HALFWAY).cast("timestamp_ntz")
    with progress.recorded(spark, f"{root}/progress") as runs:
        for part in (rows.where(~early), rows.where(early)):
            part.write.mode("append").parquet(f"{root}/in")
            events = spark.readStream.schema(rows.schema).parquet(f"{root}/in")
            running = ingest.process_stream(
                panes.pane_stream(events, dedupe=True),
                lambda batch, batch_id: panes.write_panes(batch, f"{root}/panes", batch_id),
                f"{root}/ck",
                q._ONCE,
                output_mode="update",
            )
            running.awaitTermination()
            runs.append(str(running.runId))
    kept = panes.read_panes(spark, f"{root}/panes").agg(F.sum("n").alias("accepted"))
    return progress.delivery_report(progress.read_progress(spark, f"{root}/progress"), kept)


@query
def explicit_nulls(spark: SparkSession, folder: str) -> DataFrame:
    """Every second message spells its nulls out; the others leave the fields away."""
    txns = q._txns(spark, folder)
    number = F.regexp_extract("event_id", "([0-9]+)$", 1).cast("bigint")
    spelt = tables.messages_from(txns.where(number % 2 == 0), spell_nulls=True)
    raw = spelt.unionByName(tables.messages_from(txns.where(number % 2 == 1)))
    checked = validation.validate(validation.decode_messages(raw, strict_nulls=True))
    filled = validation.with_defaults(checked)
    return filled.select(
        "event_id",
        F.concat_ws(", ", "errors").alias("errors"),
        F.when(F.size("errors") == 0, F.col("merchant_category")).alias("merchant_category"),
    )


@query
def snapshot_failure(spark: SparkSession, folder: str) -> DataFrame:
    """Snapshots can't be written; the batch is served all the same and its run tells why."""
    paths = panes.Paths.under(run_dir(spark, "broken"))
    paths.snapshots = "nowhere://no-such-store/snapshots"
    batch = hopping.panes(q._staged(spark, folder))
    instant = F.col("newest").withField(
        "event_timestamp", F.col("newest.event_timestamp").cast("timestamp")
    )
    panes.make_sink(paths, clock=lambda: q.NOW)(batch.withColumn("newest", instant), 0)
    runs = read_log(spark, paths.runs, panes.RUN)
    served = serving.live(serving.read_serving(spark, paths.serving, "realtime"), q.NOW)
    return served.select(
        "account_id",
        "txn_count_1h",
        "txn_amount_sum_1h",
        runs.agg(F.bool_and(F.col("snapshot_error").isNotNull())).scalar().alias("failed"),
        runs.agg(F.sum("features_written")).scalar().alias("features_written"),
    )


@query
def schema_report(spark: SparkSession, folder: str) -> DataFrame:
    """The registry against a frame that lacks one feature and has another with a wrong type."""
    frame = serving.model_input(q._vectors(spark, folder))
    broken = frame.drop("txn_count_30d").withColumn(
        "is_new_merchant", F.col("is_new_merchant").cast("string")
    )
    report = registry.schema_report(broken, complete=False)
    return report.select("name", "expected", "actual", "status")


@query
def message_cap(spark: SparkSession, folder: str) -> DataFrame:
    """A stream that is stopped by a cap: whole batches were taken, enough of them, and all are stored."""
    spark = stream_session(spark)
    root = run_dir(spark, "cap")
    parts = 8
    raw = q._messages(spark, folder).withColumn("part", F.col("offset") % parts)
    # A class is a task and a file, and so are messages without an offset; nothing is sorted.
    number = F.coalesce("part", F.lit(parts)).cast("int")
    raw.repartitionById(parts + 1, number).drop("part").write.parquet(f"{root}/in")
    stream = (
        spark.readStream.schema(raw.drop("part").schema)
        .option("maxFilesPerTrigger", 1)
        .parquet(f"{root}/in")
    )
    running = ingest.write_checked(
        stream, f"{root}/out", f"{root}/ck", {"processingTime": "0 seconds"}
    )
    cap = raw.count() // 4
    taken = ingest.stop_after(running, cap, poll_seconds=0.1)
    stored = ingest.read_checked(spark, f"{root}/out")
    # Batches are files: each offset class is stored whole or not at all.
    whole = (
        stored.groupBy((F.col("source_offset") % parts).alias("part")).agg(F.count(F.lit(1)).alias("n"))
        .join(raw.groupBy("part").agg(F.count(F.lit(1)).alias("all")), "part")
        .agg(F.min((F.col("n") == F.col("all")).cast("int")).alias("whole"), F.sum("n").alias("stored"))
    )
    return whole.select(
        (F.col("whole") == 1).alias("whole_batches"),
        (F.col("stored") >= cap).alias("cap_reached"),
        (F.col("stored") >= taken).alias("all_taken_are_stored"),
    )


# Homes that hold at the time of the event.


@query
def home_versions(spark: SparkSession, folder: str) -> DataFrame:
    versions = trailing.profile_versions(tables.profile_history(spark, folder))
    rows = trailing.distance_from_home(q._staged(spark, folder), versions)
    return rows.select("event_id", "account_id", "distance_from_home")


@query
def stream_home_versions(spark: SparkSession, folder: str) -> DataFrame:
    """The same join in the streaming plan itself, with the versions as a stored table."""
    spark = stream_session(spark)
    root = run_dir(spark, "homes")
    trailing.profile_versions(tables.profile_history(spark, folder)).write.parquet(f"{root}/versions")
    events = staging.clean(q._event_stream(spark, folder), q.NOW)
    located = trailing.distance_from_home(events, spark.read.parquet(f"{root}/versions"))
    (
        located.select("event_id", "account_id", "distance_from_home")
        .writeStream.format("parquet")
        .option("checkpointLocation", f"{root}/ck")
        .trigger(**q._ONCE)
        .start(f"{root}/out")
        .awaitTermination()
    )
    return spark.read.parquet(f"{root}/out")


# Stored surfaces.


def _surface(spark: SparkSession, folder: str, *stored: str) -> SparkSession:
    """A session with the objects of ``sql_surface``; the tables that a statement reads are stored.

    The others are views over what would be stored, of which nothing is computed.
    """
    session = spark.newSession()
    q.pin_utc(session)
    root = run_dir(session, "surface")
    rows = q._staged(session, folder)
    read = session.read.parquet
    dated = [daily.daily_features(rows, date, q.NOW) for date in EARLIER_DATES]
    found = {
        "daily": reduce(DataFrame.unionByName, dated),
        "snapshots": q._snaps(session, folder),
        "served": q._served_realtime(session, folder),
    }
    for name in stored:
        if name == "daily":
            for features in dated:
                write_daily(features, f"{root}/daily")
        else:
            found[name].write.parquet(f"{root}/{name}")
        found[name] = read(f"{root}/{name}")
    sql_surface.register(session, found["daily"], found["snapshots"], found["served"])
    return session


SQL_TEXTS = {
    "sql_latest": f"""SELECT * EXCEPT ({", ".join(q._AVERAGED)}),
      {", ".join(f"round({n}, 8) AS {n}" for n in q._AVERAGED)} FROM latest_account_features""",
    "sql_as_of": f"SELECT * FROM features_as_of(TIMESTAMP_NTZ '{q.ASOF}')",
    "sql_history": f"""SELECT h.* FROM (SELECT account_id FROM latest_account_features
      ORDER BY txn_count_30d DESC, account_id LIMIT 1) AS busiest,
      LATERAL account_history(busiest.account_id, TIMESTAMP_NTZ '{q.HISTORY_RANGE[0]}',
        TIMESTAMP_NTZ '{q.HISTORY_RANGE[1]}') AS h""",
    "sql_served": f"SELECT * FROM served_features(TIMESTAMP_NTZ '{q.SERVE_AT}')",
}


@query
def sql_latest(spark: SparkSession, folder: str) -> DataFrame:
    return _surface(spark, folder, "daily").sql(SQL_TEXTS["sql_latest"])


@query
def sql_as_of(spark: SparkSession, folder: str) -> DataFrame:
    return _surface(spark, folder, "snapshots").sql(SQL_TEXTS["sql_as_of"])


@query
def sql_history(spark: SparkSession, folder: str) -> DataFrame:
    return _surface(spark, folder, "daily", "snapshots").sql(SQL_TEXTS["sql_history"])


@query
def sql_served(spark: SparkSession, folder: str) -> DataFrame:
    return _surface(spark, folder, "served").sql(SQL_TEXTS["sql_served"])


@query
def stored_vector(spark: SparkSession, folder: str) -> DataFrame:
    """The merged vector from serving halves that were stored in buckets of accounts."""
    root, run = run_dir(spark, "buckets"), uuid.uuid4().hex
    halves = []
    for group, rows in (
        ("realtime", q._served_realtime(spark, folder)),
        ("batch", q._served_batch(spark, folder)),
    ):
        name = f"served_{group}_{run}"
        bucketed.write_bucketed(rows, name, f"{root}/{group}", buckets=8)
        halves.append(serving.live(bucketed.read_bucketed(spark, name), q.SERVE_AT))
    flat = serving.model_input(serving.feature_vectors(*halves, q.SERVE_AT))
    return q._rounded(flat, *q._AVERAGED)
