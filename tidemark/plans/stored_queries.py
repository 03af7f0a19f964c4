"""Queries over stored tables: logs, nightly tables, serving, expiry, retries and restarted streams.

Each writes tables from the given ones with the library's own writers, most of them more than once,
and returns what readers then see.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.clock import day
from tidemark.operators import daily, hopping, incremental, serving, snapshots, staging
from tidemark.operators.quality import EXHAUSTED
from tidemark.plans import nightly
from tidemark.plans import queries as q
from tidemark.plans.queries import query
from tidemark.session import run_dir, stream_session
from tidemark.sources import logs, tables
from tidemark.sources.feature_tables import load_events, write_days
from tidemark.streaming import ingest, panes

KEPT = T.StructType(
    [
        T.StructField("account_id", T.StringType()),
        T.StructField("event_id", T.StringType()),
        T.StructField("amount", T.DoubleType()),
    ]
)
EARLIER_DATE, EARLIER_AT = "2024-01-28", "2024-01-28 02:00:00"
BETWEEN_AT = "2024-01-28 12:00:00"
LOOKBACK_DAYS = 14
LONG = "60 days"  # a watermark that lets every event of the given month in
FAILING = 777  # the message that no handler can process


def _halves(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    rows = q._staged(spark, folder)
    early = F.col("event_timestamp") < F.lit(q.HALFWAY).cast("timestamp_ntz")
    return rows.where(early), rows.where(~early)


def _kept(rows: DataFrame) -> DataFrame:
    return rows.select(*KEPT.names)


# Logs.


@query
def log_replay(spark: SparkSession, folder: str) -> DataFrame:
    """Two batches, the second written again with other amounts."""
    path = run_dir(spark, "log")
    early, late = _halves(spark, folder)
    logs.create_log(spark, path, KEPT)
    logs.append_batch(_kept(early), path, 0)
    logs.append_batch(_kept(late), path, 1)
    logs.append_batch(_kept(late.withColumn("amount", F.col("amount") * 2)), path, 1)
    return logs.read_log(spark, path, KEPT)


@query
def log_backfill_after_compaction(spark: SparkSession, folder: str) -> DataFrame:
    """A compacted log takes in a lower batch id, and a rerun of the batch that it has folded."""
    path = run_dir(spark, "log")
    early, late = _halves(spark, folder)
    logs.create_log(spark, path, KEPT)
    logs.append_batch(_kept(late), path, 10)
    logs.compact(spark, path, KEPT)
    logs.append_batch(_kept(early), path, 5)
    logs.append_batch(_kept(late.withColumn("amount", F.col("amount") * 2)), path, 10)
    logs.remove_folded(spark, path)
    return logs.read_log(spark, path, KEPT)


@query
def log_new_checkpoint(spark: SparkSession, folder: str) -> DataFrame:
    """A stream that starts anew counts its batches from 0 again."""
    path = run_dir(spark, "log")
    early, late = _halves(spark, folder)
    logs.create_log(spark, path, KEPT)
    logs.append_batch(_kept(early), path, 0, stream="first")
    logs.append_batch(_kept(late), path, 0, stream="second")
    return logs.read_log(spark, path, KEPT)


# Serving.


def _served_twice(spark: SparkSession, folder: str) -> str:
    """Nightly features of two dates in a serving table, compacted between their writes."""
    path = run_dir(spark, "serving")
    for number, (date, at) in enumerate(
        [(EARLIER_DATE, EARLIER_AT), (q.SERVE_DATE, q.NIGHTLY_AT)]
    ):
        rows = daily.daily_features(q._staged(spark, folder, at), date, at)
        serving.upsert(rows, "batch", path, number, at)
    serving.compact_serving(spark, path, "batch", BETWEEN_AT)
    logs.remove_folded(spark, f"{path}/batch")
    return path


def _eight(rows: DataFrame) -> DataFrame:
    return q._rounded(rows, *q._AVERAGED)


@query
def compacted_serving(spark: SparkSession, folder: str) -> DataFrame:
    path = _served_twice(spark, folder)
    return _eight(
        serving.live(serving.read_serving(spark, path, "batch"), q.SERVE_AT).drop("batch_id")
    )


@query
def deleted_serving(spark: SparkSession, folder: str) -> DataFrame:
    """Customers with a negative balance are deleted by stored marks and a compaction."""
    path = _served_twice(spark, folder)
    leaving = (
        tables.read(spark, folder, "customer")
        .where(F.col("c_acctbal") < 0)
        .select(tables.account(F.col("c_custkey")).alias("account_id"))
    )
    serving.mark_deleted(leaving, path, 0, q.SERVE_AT)
    marks = serving.read_tombstones(spark, path)
    serving.compact_serving(spark, path, "batch", q.SERVE_AT, marks)
    logs.remove_folded(spark, f"{path}/batch")
    return serving.read_serving(spark, path, "batch").select(
        "account_id", "written_at", "expires_at"
    )


@query
def serving_json(spark: SparkSession, folder: str) -> DataFrame:
    """Nightly features as keys and JSON values, and back."""
    stored = serving.key_values(q._served_batch(spark, folder), "batch")
    path = run_dir(spark, "values")
    stored.write.parquet(path)
    return _eight(serving.from_key_values(spark.read.parquet(path), "batch"))


# The nightly run, twice for one date: the second time with corrected amounts.


def _nightly(spark: SparkSession, folder: str) -> nightly.Paths:
    paths = nightly.Paths.under(run_dir(spark, "nightly"))
    txns = q._txns(spark, folder)
    for rows in (txns.withColumn("amount", F.col("amount") / 2), txns):
        steps = nightly.run_daily(spark, rows, paths, q.SERVE_DATE, q.NIGHTLY_AT)
        if steps[-1].state != "done":
            raise RuntimeError(str(steps))
    return paths


@query
def nightly_daily(spark: SparkSession, folder: str) -> DataFrame:
    return _eight(spark.read.parquet(_nightly(spark, folder).daily))


@query
def nightly_rolling(spark: SparkSession, folder: str) -> DataFrame:
    return q._rounded(spark.read.parquet(_nightly(spark, folder).rolling), "metric_value")


@query
def nightly_snapshot(spark: SparkSession, folder: str) -> DataFrame:
    path = _nightly(spark, folder).snapshots
    return _eight(logs.read_log(spark, path, nightly.SNAPSHOT))


@query
def nightly_served(spark: SparkSession, folder: str) -> DataFrame:
    path = _nightly(spark, folder).serving
    return _eight(
        serving.live(serving.read_serving(spark, path, "batch"), q.SERVE_AT).drop("batch_id")
    )


DELTA_DATES = [f"1998-07-{d:02d}" for d in range(20, 30)]


@query
def nightly_delta(spark: SparkSession, folder: str) -> DataFrame:
    """Ten dates in a row, each from its own day, the day it retires and the state before it.

    The source is kept by day first, as a nightly run finds it: every date reads it for four tables.
    """
    root = run_dir(spark, "delta")
    paths = nightly.Paths.under(root)
    history = tables.card_history(spark, folder)
    first = F.date_sub(day(DELTA_DATES[0]), incremental.KEPT_DAYS)
    read = F.col("transaction_date").between(first, day(DELTA_DATES[-1]))
    write_days(history.where(read), f"{root}/transactions")
    txns = spark.read.schema(history.schema).parquet(f"{root}/transactions")
    for date in DELTA_DATES:
        nightly.build(spark, txns, paths, date, f"{date} 23:59:59", by_delta=True)
    metrics = [(m, w) for w in daily.WINDOWS for m in ("avg_amount", "txn_count", "distinct_merchants")]
    at = ["account_id", "computation_date"]
    rolling = spark.read.parquet(paths.rolling).groupBy(*at).agg(
        *[
            F.max(
                F.when(
                    (F.col("metric_name") == m) & (F.col("window_days") == w),
                    F.round("metric_value", 8),
                )
            ).alias(f"{m}_{w}")
            for m, w in metrics
        ]
    )
    return _eight(spark.read.parquet(paths.daily)).join(rolling, at, "left")


# Snapshots.


@query
def snapshots_after_expiry(spark: SparkSession, folder: str) -> DataFrame:
    path = run_dir(spark, "snapshots")
    logs.create_log(spark, path, panes.SNAPSHOT)
    logs.append_batch(q._snaps(spark, folder), path, 0)
    snapshots.expire_snapshots(spark, path, panes.SNAPSHOT, q.NOW)
    return logs.read_log(spark, path, panes.SNAPSHOT).drop("batch_id")


@query
def asof_lookback(spark: SparkSession, folder: str) -> DataFrame:
    """As q_asof_training_set, but requests older than the look-back find nothing."""
    requests = q._staged(spark, folder).select(
        "account_id",
        (F.col("event_timestamp") - F.expr("INTERVAL 1 HOUR")).alias("as_of"),
        "event_id",
    )
    found = snapshots.features_asof(
        q._snaps(spark, folder), requests, now=q.NOW, max_lookback_days=LOOKBACK_DAYS
    )
    return found.select("account_id", "as_of", "event_id", "computed_at", "snapshot_id")


# Files and messages.


@query
def time_order(spark: SparkSession, folder: str) -> DataFrame:
    return staging.in_time_order(q._staged(spark, folder)).select("event_id", "event_timestamp")


@query
def event_lines(spark: SparkSession, folder: str) -> DataFrame:
    """Events as lines of JSON, loaded and validated."""
    path = run_dir(spark, "lines")
    q._messages(spark, folder).select("value").write.text(path)
    return load_events(spark, path)


@query
def retry_dead_letter(spark: SparkSession, folder: str) -> DataFrame:
    """A handler that fails on one message: that one is set aside, all others are processed."""
    root = run_dir(spark, "handled")
    position = T.StructType([T.StructField("offset", T.LongType())])
    logs.create_log(spark, f"{root}/done", position)

    def handler(batch: DataFrame, batch_id: int) -> None:
        if not batch.where(F.col("offset") == FAILING).isEmpty():
            raise ValueError("a message that can't be processed")
        logs.append_batch(batch.select("offset"), f"{root}/done", batch_id, sort_by=None)

    ingest.with_retries(handler, f"{root}/dead", max_retries=2, delay_seconds=0.0)(
        q._messages(spark, folder), 0
    )
    done = logs.read_log(spark, f"{root}/done", position)
    dead = spark.read.parquet(f"{root}/dead/log").where(F.col("error_reason") == EXHAUSTED)
    return done.select("offset", F.lit("processed").alias("outcome")).unionByName(
        dead.select(F.col("source_offset").alias("offset"), F.lit("failed").alias("outcome"))
    )


# Streams over two runs of one checkpoint.


def _two_runs(
    spark: SparkSession, parts: list[DataFrame], watermark: str, dedupe: bool = False
) -> DataFrame:
    """Windows over the panes that a stream stores when its input arrives in two parts."""
    root = run_dir(spark, "runs")
    for part in parts:
        part.write.mode("append").parquet(f"{root}/in")
        events = spark.readStream.schema(part.schema).parquet(f"{root}/in")
        ingest.process_stream(
            panes.pane_stream(events, watermark, dedupe=dedupe),
            lambda batch, batch_id: panes.write_panes(batch, f"{root}/panes", batch_id),
            f"{root}/ck",
            q._ONCE,
            output_mode="update",
        ).awaitTermination()
    return hopping.windows_over(panes.read_panes(spark, f"{root}/panes")).drop("pane_end")


@query
def late_rows(spark: SparkSession, folder: str) -> DataFrame:
    """The first half of the month arrives after the second: all of it is late."""
    spark = stream_session(spark, backlog=True)
    early, late = _halves(spark, folder)
    return _two_runs(spark, [late, early], panes.WATERMARK)


@query
def stream_updates(spark: SparkSession, folder: str) -> DataFrame:
    """Every pane may change in the second run, and then replaces what the first one stored."""
    spark = stream_session(spark, backlog=True)
    rows = q._staged(spark, folder)
    odd = F.pmod(F.xxhash64("event_id"), F.lit(2)) == 1
    return _two_runs(spark, [rows.where(odd), rows.where(~odd)], LONG)


@query
def stream_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """Every event arrives in both runs and counts once."""
    spark = stream_session(spark, backlog=True)
    rows = q._staged(spark, folder)
    return _two_runs(spark, [rows, rows], LONG, dedupe=True)
