"""Every operator as a named query over the given tables."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark import schemas as S
from tidemark.operators import daily, hopping, quality, registry, serving, sketches, snapshots
from tidemark.operators import staging, trailing, validation
from tidemark.operators.pane_frames import counts_by_pane
from tidemark.functions.clock import hour_of_day, is_weekend, micros
from tidemark.functions.keys import route_partition
from tidemark.functions.numbers import velocity
from tidemark.session import pin_utc, run_dir, stream_session, wide_session
from tidemark.sources import feature_tables, tables
from tidemark.sources.feature_tables import conform_batch, new_rolling
from tidemark.sources.messages import publish_frame
from tidemark.streaming import ingest, panes, rows as handled_rows, visits

NOW = "2024-02-05 00:00:00"
TARGET_DATE = "2024-02-05"
HISTORY_DATE = "1998-09-01"
HISTORY_NOW = "1998-09-02 00:00:00"
FIRST_SKETCH = "1998-06-01"  # 92 days before HISTORY_DATE
SERVE_AT = "2024-01-29 12:00:00"
SERVE_DATE = "2024-01-29"
NIGHTLY_AT = "2024-01-29 02:00:00"
ASOF = "2024-01-20 00:00:00"
HALFWAY = "2024-01-16 00:00:00"
THIRDS = ("2024-01-11 00:00:00", "2024-01-21 00:00:00")
PAIR = ("2024-01-15 00:00:00", "2024-01-25 00:00:00")
HISTORY_RANGE = ("2024-01-10 00:00:00", "2024-01-20 00:00:00")

Query = Callable[[SparkSession, str], DataFrame]
_QUERIES: dict[str, Query] = {}


def query(fn: Query) -> Query:
    """Register a query under its function name; one trailing underscore is dropped."""

    def run(spark: SparkSession, folder: str) -> DataFrame:
        return fn(pin_utc(spark), folder)

    _QUERIES[f"q_{fn.__name__.removesuffix('_')}"] = run
    return fn


def registered() -> dict[str, Query]:
    return dict(_QUERIES)


# Inputs shared by several queries.


def _txns(spark: SparkSession, folder: str) -> DataFrame:
    return tables.transactions(spark, folder)


def _staged(spark: SparkSession, folder: str, now: str = NOW) -> DataFrame:
    return staging.clean(_txns(spark, folder), now)


def _history(spark: SparkSession, folder: str) -> DataFrame:
    return staging.clean(tables.card_history(spark, folder), HISTORY_NOW)


def _messages(spark: SparkSession, folder: str) -> DataFrame:
    return tables.messages_from(_txns(spark, folder))


def _decoded(spark: SparkSession, folder: str) -> DataFrame:
    return validation.decode_messages(_messages(spark, folder))


def _split(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    return validation.split_valid(_decoded(spark, folder), NOW)


def _hops(spark: SparkSession, folder: str, now: str = NOW) -> DataFrame:
    return hopping.hop_features(_staged(spark, folder, now))


def _snaps(spark: SparkSession, folder: str) -> DataFrame:
    """One realtime snapshot per account and pane, committed when the pane closes."""
    rows = hopping.realtime_rows(
        _hops(spark, folder), F.col("last_event_time"), extra=("window_end",)
    )
    stamped = snapshots.stamp(rows, micros(F.col("window_end")), F.col("window_end"))
    return stamped.drop("window_end")


def _served_realtime(spark: SparkSession, folder: str) -> DataFrame:
    rows = hopping.realtime_rows(
        _hops(spark, folder, SERVE_AT), F.col("last_event_time"), extra=("window_end",)
    )
    at = F.col("window_end")
    return serving.serving_rows(rows, "realtime", at, batch_id=micros(at))


def _served_batch(spark: SparkSession, folder: str) -> DataFrame:
    rows = daily.daily_features(_staged(spark, folder, NIGHTLY_AT), SERVE_DATE, NIGHTLY_AT)
    return serving.serving_rows(rows, "batch", NIGHTLY_AT, batch_id=1)


def _vectors(spark: SparkSession, folder: str) -> DataFrame:
    return serving.feature_vectors(
        serving.live(_served_realtime(spark, folder), SERVE_AT),
        serving.live(_served_batch(spark, folder), SERVE_AT),
        SERVE_AT,
    )


def _rounded(df: DataFrame, *names: str, places: int = 8) -> DataFrame:
    """Sums differ in the last bit with their order; compare what is meant."""
    return df.withColumns({n: F.round(n, places) for n in names})


_AVERAGED = [
    "avg_txn_amount_30d",
    "txn_amount_p50_90d",
    "txn_amount_p95_90d",
    "txn_amount_p99_90d",
    "avg_daily_txn_count_30d",
    "pct_online_txns_30d",
]


# A handler that can't take the messages of some offsets.

CENTS = T.StructType([T.StructField("account", T.StringType()), T.StructField("cents", T.LongType())])
REFUSED_EVERY, REFUSED_AT = 97, 5


def _in_cents(batch: pa.RecordBatch) -> pa.RecordBatch:
    offsets = batch.column("source_offset").to_numpy()
    if (offsets % REFUSED_EVERY == REFUSED_AT).any():
        raise LookupError("no ledger for this message")
    cents = np.floor(batch.column("amount").to_numpy() * 100 + 0.5).astype(np.int64)
    return pa.RecordBatch.from_arrays([batch.column("account_id"), pa.array(cents)], CENTS.names)


def _handled(spark: SparkSession, folder: str) -> DataFrame:
    return handled_rows.handled(_messages(spark, folder), _in_cents, CENTS, max_retries=2)


_ONCE = {"availableNow": True}


def _event_stream(spark: SparkSession, folder: str) -> DataFrame:
    schema = tables.read(spark, folder, "events").schema
    # A pattern that only the table matches: it may be one file or a folder of part files.
    return tables.transactions_from(
        spark.readStream.schema(schema).parquet(f"{folder}/events.parque[t]")
    )


# Messages, validation, staging.


@query
def decode_messages(spark: SparkSession, folder: str) -> DataFrame:
    helpers = ["_unreadable", "_malformed", "value", "topic", "partition", "offset"]
    return _decoded(spark, folder).drop(*helpers)


@query
def validate_events(spark: SparkSession, folder: str) -> DataFrame:
    return validation.validate(_decoded(spark, folder)).select(
        "event_id",
        "account_id",
        F.concat_ws(", ", "errors").alias("errors"),
        (F.size("errors") == 0).alias("is_valid"),
    )


@query
def valid_events(spark: SparkSession, folder: str) -> DataFrame:
    return _split(spark, folder)[0]


@query
def dead_letter(spark: SparkSession, folder: str) -> DataFrame:
    dead = _split(spark, folder)[1]
    return dead.select(
        F.get_json_object("original_message", "$.event_id").alias("event_id"),
        "error_reason",
        "source_topic",
        "source_partition",
        "source_offset",
        "failed_at",
    )


@query
def redrive(spark: SparkSession, folder: str) -> DataFrame:
    dead = _split(spark, folder)[1]
    return validation.redrive(dead).select(
        "event_id", "account_id", "amount", F.concat_ws(", ", "errors").alias("errors")
    )


@query
def ingest_stats(spark: SparkSession, folder: str) -> DataFrame:
    """What became of every message when a handler gives up on some of them; one scan."""
    return quality.outcome_stats(_handled(spark, folder))


@query
def handled_messages(spark: SparkSession, folder: str) -> DataFrame:
    """Every message with its outcome; what the handler returned, or why there is nothing."""
    return _handled(spark, folder).select(
        F.col("source_offset").alias("offset"), "outcome", "attempts", "account", "cents"
    )


@query
def handled_dead_letter(spark: SparkSession, folder: str) -> DataFrame:
    """Broken messages and those that the handler gave up on, read back from the stored outcomes."""
    path = run_dir(spark, "handled")
    handled_rows.write_batch(
        _messages(spark, folder), _in_cents, CENTS, path, 0, max_retries=2, delay_seconds=0.0
    )
    stored = handled_rows.read_handled(spark, path, CENTS)
    dead = handled_rows.set_aside(stored, NOW)
    return dead.select(
        F.get_json_object("original_message", "$.event_id").alias("event_id"),
        "error_reason",
        "source_offset",
        F.col("metadata")["error"].alias("error"),
        F.col("metadata")["attempts"].alias("attempts"),
    )


@query
def dlq_depth(spark: SparkSession, folder: str) -> DataFrame:
    dead = _split(spark, folder)[1]
    return quality.dlq_depth(dead, threshold=1000)


@query
def staging_(spark: SparkSession, folder: str) -> DataFrame:
    return _staged(spark, folder)


@query
def event_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """Every event delivered twice, as an at-least-once source may."""
    txns = _txns(spark, folder)
    once = staging.dedupe(txns.unionByName(txns))
    return once.select("event_id", "account_id", "event_timestamp", "amount")


@query
def publish(spark: SparkSession, folder: str) -> DataFrame:
    rows = _split(spark, folder)[0]
    return publish_frame(rows).select(
        "key",
        "partition",
        F.get_json_object("value", "$.event_id").alias("event_id"),
        F.get_json_object("value", "$.transaction_type").alias("transaction_type"),
    )


@query
def route_partition_(spark: SparkSession, folder: str) -> DataFrame:
    return _txns(spark, folder).select(
        "event_id", "account_id", route_partition(F.col("account_id")).alias("partition")
    )


# Per-event realtime features.


@query
def trailing_1h(spark: SparkSession, folder: str) -> DataFrame:
    keep = ["event_id", "account_id", "event_timestamp"]
    return counts_by_pane(_staged(wide_session(spark), folder), keep).drop("txn_count_5m")


@query
def velocity_5m(spark: SparkSession, folder: str) -> DataFrame:
    rows = counts_by_pane(_staged(wide_session(spark), folder), ["event_id", "account_id"])
    n5m, n1h = F.col("txn_count_5m"), F.col("txn_count_1h")
    return rows.select(
        "event_id",
        "account_id",
        "txn_count_5m",
        velocity(n5m, n1h).alias("txn_velocity_5m"),
        velocity(n5m, n1h, "hourly").alias("velocity_hourly"),
        velocity(n5m, n1h, "per_minute").alias("velocity_per_minute"),
    )


@query
def is_new_merchant(spark: SparkSession, folder: str) -> DataFrame:
    rows = trailing.is_new_merchant(_staged(spark, folder))
    return rows.select("event_id", "account_id", "merchant_id", "is_new_merchant")


@query
def distance_from_home(spark: SparkSession, folder: str) -> DataFrame:
    rows = trailing.distance_from_home(_staged(spark, folder), tables.profiles(spark, folder))
    return rows.select("event_id", "account_id", "distance_from_home")


@query
def event_clock(spark: SparkSession, folder: str) -> DataFrame:
    ts = F.col("event_timestamp")
    return _staged(spark, folder).select(
        "event_id", hour_of_day(ts).alias("hour_of_day"), is_weekend(ts).alias("is_weekend")
    )


@query
def realtime_vector(spark: SparkSession, folder: str) -> DataFrame:
    spark = wide_session(spark)
    homes = tables.profiles(spark, folder)
    return trailing.trailing_features(_staged(spark, folder), homes, counts=counts_by_pane)


@query
def last_values(spark: SparkSession, folder: str) -> DataFrame:
    return trailing.last_values(_staged(spark, folder))


@query
def hop_1h(spark: SparkSession, folder: str) -> DataFrame:
    return _hops(spark, folder)


@query
def realtime_projection(spark: SparkSession, folder: str) -> DataFrame:
    return hopping.realtime_rows(_hops(spark, folder), NOW, "hourly", extra=("window_end",))


# Nightly features.


@query
def daily_features(spark: SparkSession, folder: str) -> DataFrame:
    rows = daily.daily_features(_staged(spark, folder), TARGET_DATE, NOW)
    return _rounded(rows, *_AVERAGED)


@query
def daily_joined(spark: SparkSession, folder: str) -> DataFrame:
    rows = daily.daily_features_joined(_staged(spark, folder), TARGET_DATE, NOW)
    return _rounded(rows, *_AVERAGED)


@query
def daily_features_v2(spark: SparkSession, folder: str) -> DataFrame:
    rows = daily.daily_features_v2(_staged(spark, folder), TARGET_DATE, NOW)
    return _rounded(rows, *_AVERAGED)


@query
def history_daily(spark: SparkSession, folder: str) -> DataFrame:
    rows = daily.daily_features(_history(spark, folder), HISTORY_DATE, HISTORY_NOW)
    return _rounded(rows, *_AVERAGED)


@query
def fetch_daily(spark: SparkSession, folder: str) -> DataFrame:
    rows = daily.daily_features(_history(spark, folder), HISTORY_DATE, HISTORY_NOW)
    return _rounded(conform_batch(rows), *_AVERAGED)


@query
def rolling_metrics(spark: SparkSession, folder: str) -> DataFrame:
    rows = daily.rolling_metrics(_staged(spark, folder), TARGET_DATE, NOW)
    return _rounded(rows, "metric_value")


@query
def rolling_union(spark: SparkSession, folder: str) -> DataFrame:
    rows = daily.rolling_metrics_union(_staged(spark, folder), TARGET_DATE, NOW)
    return _rounded(rows, "metric_value")


@query
def history_rolling(spark: SparkSession, folder: str) -> DataFrame:
    rows = daily.rolling_metrics(_history(spark, folder), HISTORY_DATE, HISTORY_NOW)
    return _rounded(rows, "metric_value")


@query
def rolling_incremental(spark: SparkSession, folder: str) -> DataFrame:
    """A rerun against a table that already has the seven-day window of the same date."""
    staged = _staged(spark, folder)
    existing = daily.rolling_metrics(staged, TARGET_DATE, NOW, windows=(7,))
    rows = new_rolling(daily.rolling_metrics(staged, TARGET_DATE, NOW), existing)
    return _rounded(rows, "metric_value").select(*S.ROLLING.names)


@query
def sketch_accuracy(spark: SparkSession, folder: str) -> DataFrame:
    """Estimates of stored day sketches, each judged by the exact value."""
    path = run_dir(spark, "sketches")
    history = _history(spark, folder)
    feature_tables.write_days(sketches.day_sketches(history, FIRST_SKETCH, HISTORY_DATE), path)
    stored = spark.read.parquet(path)
    found = sketches.estimates(sketches.window_sketches(stored, HISTORY_DATE))
    return sketches.accuracy(found, history, HISTORY_DATE)


@query
def sketch_features(spark: SparkSession, folder: str) -> DataFrame:
    """The exact columns of nightly features whose other columns are estimates."""
    path = run_dir(spark, "sketches")
    history = _history(spark, folder)
    span = (FIRST_SKETCH, HISTORY_DATE)
    feature_tables.write_days(sketches.day_sketches(history, *span), f"{path}/sketches")
    feature_tables.write_days(sketches.day_categories(history, *span), f"{path}/categories")
    rows = sketches.estimated_features(
        spark.read.parquet(f"{path}/sketches"),
        spark.read.parquet(f"{path}/categories"),
        HISTORY_DATE,
        HISTORY_NOW,
    )
    estimated = ["distinct_merchants_30d", "distinct_merchants_7d", *daily.PERCENTILES]
    return _rounded(rows.drop(*estimated), *[n for n in _AVERAGED if n not in estimated])


@query
def latest_features(spark: SparkSession, folder: str) -> DataFrame:
    staged = _staged(spark, folder)
    days = ["2024-01-20", "2024-01-30"]
    both = daily.daily_features(staged, days[0], NOW).unionByName(
        daily.daily_features(staged, days[1], NOW)
    )
    return _rounded(daily.latest_features(both), *_AVERAGED)


@query
def bootstrap_features(spark: SparkSession, folder: str) -> DataFrame:
    return daily.bootstrap_batch(_staged(spark, folder), NOW)


@query
def bootstrap_realtime(spark: SparkSession, folder: str) -> DataFrame:
    return daily.bootstrap_realtime(_staged(spark, folder), NOW)


@query
def txn_summary(spark: SparkSession, folder: str) -> DataFrame:
    rows = daily.txn_summary(tables.card_history(spark, folder))
    return _rounded(rows, "avg_amount", "high_value_share", places=4)


# Snapshots and time travel.


@query
def asof_features(spark: SparkSession, folder: str) -> DataFrame:
    return snapshots.features_at(_snaps(spark, folder), ASOF).drop("batch_id")


@query
def asof_training_set(spark: SparkSession, folder: str) -> DataFrame:
    """What was known one hour before every event."""
    requests = _staged(spark, folder).select(
        "account_id",
        (F.col("event_timestamp") - F.expr("INTERVAL 1 HOUR")).alias("as_of"),
        "event_id",
    )
    return snapshots.features_asof(_snaps(spark, folder), requests).drop("batch_id")


@query
def feature_history(spark: SparkSession, folder: str) -> DataFrame:
    return snapshots.feature_history(_snaps(spark, folder), *HISTORY_RANGE).drop("batch_id")


@query
def feature_diff(spark: SparkSession, folder: str) -> DataFrame:
    before, after = (F.lit(t).cast("timestamp_ntz") for t in PAIR)
    pairs = tables.profiles(spark, folder).select(
        "account_id", before.alias("timestamp_a"), after.alias("timestamp_b")
    )
    return _rounded(snapshots.feature_diff(_snaps(spark, folder), pairs), "delta")


@query
def snapshots_to_expire(spark: SparkSession, folder: str) -> DataFrame:
    return snapshots.snapshots_to_expire(snapshots.commits(_snaps(spark, folder)), NOW)


# Serving.


@query
def serving_live(spark: SparkSession, folder: str) -> DataFrame:
    return serving.live(_served_realtime(spark, folder), SERVE_AT).drop("batch_id")


@query
def feature_vector(spark: SparkSession, folder: str) -> DataFrame:
    v = _vectors(spark, folder)
    flat = v.select(
        "account_id",
        *[F.col(f"realtime.{n}").alias(f"rt_{n}") for n in S.REALTIME.names if n != "account_id"],
        *[F.col(f"batch.{n}").alias(f"bt_{n}") for n in S.BATCH.names if n != "account_id"],
        "served_at",
        "feature_store_version",
    )
    return _rounded(flat, *[f"bt_{n}" for n in _AVERAGED])


@query
def model_input(spark: SparkSession, folder: str) -> DataFrame:
    return _rounded(serving.model_input(_vectors(spark, folder)), *_AVERAGED)


@query
def features_by_tag(spark: SparkSession, folder: str) -> DataFrame:
    rows = registry.select_features(
        serving.model_input(_vectors(spark, folder)), tag="fraud-signal", complete=False
    )
    return _rounded(rows, "txn_amount_p95_90d")


@query
def features_by_path(spark: SparkSession, folder: str) -> DataFrame:
    rows = registry.feature_profile(
        serving.model_input(_vectors(spark, folder)), path="cold", complete=False
    )
    return _rounded(rows, "min_value", "max_value")


@query
def delete_account(spark: SparkSession, folder: str) -> DataFrame:
    """What is still served after every customer with a negative balance has been deleted."""
    leaving = (
        tables.read(spark, folder, "customer")
        .where(F.col("c_acctbal") < 0)
        .select(tables.account(F.col("c_custkey")).alias("account_id"))
    )
    left = [
        serving.delete_accounts(serving.live(rows, SERVE_AT), leaving).select(
            "account_id", F.lit(group).alias("feature_group"), "written_at", "expires_at"
        )
        for group, rows in (
            ("realtime", _served_realtime(spark, folder)),
            ("batch", _served_batch(spark, folder)),
        )
    ]
    return left[0].unionByName(left[1])


@query
def serving_keys(spark: SparkSession, folder: str) -> DataFrame:
    accounts = tables.profiles(spark, folder)
    return serving.serving_keys(accounts, "realtime").unionByName(
        serving.serving_keys(accounts, "batch")
    )


# Quality.


@query
def quality_gate(spark: SparkSession, folder: str) -> DataFrame:
    features = daily.daily_features(_staged(spark, folder), TARGET_DATE, NOW)
    return quality.quality_gate(features, serving.live(_served_batch(spark, folder), SERVE_AT))


@query
def freshness(spark: SparkSession, folder: str) -> DataFrame:
    realtime = serving.live(_served_realtime(spark, folder), SERVE_AT)
    batch = serving.live(_served_batch(spark, folder), SERVE_AT)
    return quality.freshness_summary(realtime, SERVE_AT, "realtime").unionByName(
        quality.freshness_summary(batch, SERVE_AT, "batch")
    )


@query
def skew_report(spark: SparkSession, folder: str) -> DataFrame:
    """Served hourly totals against the exact trailing hour at each account's newest event."""
    staged = _staged(wide_session(spark), folder)
    hot = serving.newest(
        serving.serving_rows(
            hopping.realtime_rows(
                hopping.hop_features(staged), F.col("last_event_time"), extra=("window_end",)
            ),
            "realtime",
            F.col("window_end"),
            batch_id=micros(F.col("window_end")),
        )
    )
    rows = trailing.trailing_features(staged, counts=counts_by_pane)
    names = ["txn_count_1h", "txn_amount_sum_1h", "txn_amount_max_1h", "is_new_merchant"]
    cold = (
        rows.groupBy("account_id")
        .agg(F.max_by(F.struct(*names), F.struct("computed_at", "event_id")).alias("v"))
        .select("account_id", "v.*")
    )
    return _rounded(quality.skew_report(hot, cold, names, tolerance=0.005), "gap")


# Streams: each runs over the whole event table as a stream and reads back what it stored.


def _stream_checked(spark: SparkSession, folder: str, name: str) -> DataFrame:
    spark = stream_session(spark)
    root = run_dir(spark, name)
    messages = tables.messages_from(_event_stream(spark, folder))
    ingest.write_checked(messages, f"{root}/checked", f"{root}/ck", _ONCE).awaitTermination()
    return ingest.read_checked(spark, f"{root}/checked")


@query
def stream_valid_events(spark: SparkSession, folder: str) -> DataFrame:
    return ingest.valid_events(_stream_checked(spark, folder, "valid"))


@query
def stream_dead_letter(spark: SparkSession, folder: str) -> DataFrame:
    dead = ingest.dead_letters(_stream_checked(spark, folder, "dead"))
    return dead.select(
        F.get_json_object("original_message", "$.event_id").alias("event_id"),
        "error_reason",
        "source_topic",
        "source_partition",
        "source_offset",
    )


@query
def stream_first_visits(spark: SparkSession, folder: str) -> DataFrame:
    spark = stream_session(spark)
    root = run_dir(spark, "visits")
    events = staging.clean(_event_stream(spark, folder), NOW)
    ingest.write_first_visits(events, f"{root}/out", f"{root}/ck", _ONCE).awaitTermination()
    visits = ingest.read_first_visits(spark, f"{root}/out")
    return visits.select("account_id", "merchant_id", "event_id")


@query
def stream_hop_1h(spark: SparkSession, folder: str) -> DataFrame:
    spark = stream_session(spark)
    root = run_dir(spark, "panes")
    stream = panes.pane_stream(staging.clean(_event_stream(spark, folder), NOW))
    ingest.process_stream(
        stream,
        lambda batch, batch_id: panes.write_panes(batch, f"{root}/panes", batch_id),
        f"{root}/ck",
        _ONCE,
        output_mode="update",
    ).awaitTermination()
    return hopping.windows_over(panes.read_panes(spark, f"{root}/panes")).drop("pane_end")


@query
def stream_served(spark: SparkSession, folder: str) -> DataFrame:
    """The whole hot path: events to panes to served rows, over two runs with a restart between."""
    spark = stream_session(spark)
    paths = panes.Paths.under(run_dir(spark, "served"))
    source, flagged = f"{paths.runs}-in", f"{paths.runs}-flagged"
    sink = panes.make_sink(paths, tables.profiles(spark, folder), lambda: NOW)
    early = F.col("event_timestamp") < F.lit(HALFWAY).cast("timestamp_ntz")
    rows = _staged(spark, folder)
    for part in (rows.where(early), rows.where(~early)):
        part.write.mode("append").parquet(source)
        events = spark.readStream.schema(rows.schema).parquet(source)
        visits.write_flagged(events, flagged, f"{paths.runs}-ck-v", _ONCE).awaitTermination()
        stream = panes.pane_stream(visits.stream_flagged(spark, flagged, rows.schema), flagged=True)
        ingest.process_stream(
            stream, sink, f"{paths.runs}-ck", _ONCE, output_mode="update"
        ).awaitTermination()
    rows = serving.live(serving.read_serving(spark, paths.serving, "realtime"), NOW)
    return rows.drop("batch_id")


@query
def stream_new_merchant(spark: SparkSession, folder: str) -> DataFrame:
    """Flags from keyed state over three runs of one checkpoint, each with a third of the month."""
    spark = stream_session(spark)
    root = run_dir(spark, "flags")
    rows = _staged(spark, folder)
    at = F.col("event_timestamp")
    first, second = (F.lit(t).cast("timestamp_ntz") for t in THIRDS)
    for part in (rows.where(at < first), rows.where((at >= first) & (at < second)), rows.where(at >= second)):
        part.write.mode("append").parquet(f"{root}/in")
        events = spark.readStream.schema(rows.schema).parquet(f"{root}/in")
        visits.write_flagged(events, f"{root}/out", f"{root}/ck", _ONCE).awaitTermination()
    flagged = spark.read.parquet(f"{root}/out")
    return flagged.select("event_id", "account_id", "merchant_id", "is_new_merchant")
