"""Message stream to checked rows: every message is decoded, validated and kept exactly once."""

from __future__ import annotations

import time
from collections.abc import Callable
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from tidemark import schemas as S
from tidemark.functions.clock import day
from tidemark.operators.quality import EXHAUSTED
from tidemark.operators.validation import (
    check,
    decode_messages,
    envelope,
    error_reason,
    with_defaults,
)
from tidemark.session import run_dir
from tidemark.sources.logs import append_batch, create_log, read_log, remove_path

Handler = Callable[[DataFrame, int], None]

_EVENT = [f for f in S.TRANSACTION if f.name not in ("transaction_date", "ingested_at")]
CHECKED = T.StructType(
    [
        *_EVENT,
        T.StructField("original_message", T.StringType()),
        T.StructField("error_reason", T.StringType()),
        T.StructField("source_topic", T.StringType()),
        T.StructField("source_partition", T.IntegerType()),
        T.StructField("source_offset", T.LongType()),
        T.StructField("checked_at", T.TimestampNTZType()),
        T.StructField("outcome", T.StringType()),
    ]
)

VISIT = T.StructType(
    [
        T.StructField("account_id", T.StringType()),
        T.StructField("merchant_id", T.StringType()),
        T.StructField("event_id", T.StringType()),
        T.StructField("event_timestamp", T.TimestampNTZType()),
        # The newest event of the pair that the row takes into account.
        T.StructField("seen_at", T.TimestampNTZType()),
        T.StructField("seen_event_id", T.StringType()),
    ]
)


def checked_rows(messages: DataFrame, keep_message: bool = False) -> DataFrame:
    """One row per message with its outcome, valid or dead; works on streams and tables alike.

    Valid rows lose their text unless ``keep_message`` is set.
    """
    rows = with_defaults(check(decode_messages(messages)))
    bad = F.col("error_text") != ""
    return rows.select(
        *[f.name for f in _EVENT],
        (F.col("value") if keep_message else F.when(bad, F.col("value"))).alias("original_message"),
        F.when(bad, error_reason()).alias("error_reason"),
        F.col("topic").alias("source_topic"),
        F.col("partition").cast("int").alias("source_partition"),
        F.col("offset").cast("bigint").alias("source_offset"),
        F.current_timestamp().cast("timestamp_ntz").alias("checked_at"),
        F.when(bad, "dead").otherwise("valid").alias("outcome"),
    )


def valid_events(checked: DataFrame) -> DataFrame:
    """The accepted events of a checked table or stream; a partition filter on disk."""
    return checked.where(F.col("outcome") == "valid").select(*[f.name for f in _EVENT])


def dead_letters(checked: DataFrame) -> DataFrame:
    """The rejected messages of a checked table as envelopes."""
    return checked.where(F.col("outcome") == "dead").select(
        "original_message",
        "error_reason",
        "source_topic",
        "source_partition",
        "source_offset",
        F.col("checked_at").alias("failed_at"),
        F.create_map().cast(T.MapType(T.StringType(), T.StringType())).alias("metadata"),
    )


def write_checked(
    messages: DataFrame, path: str, checkpoint: str, trigger: dict | None = None
) -> StreamingQuery:
    """Run the check as a stream into one table, parted by outcome.

    The file sink commits each micro-batch once, so neither valid rows nor dead letters double when
    a batch is retried.
    """
    return (
        checked_rows(messages)
        .writeStream.format("parquet")
        .outputMode("append")
        .partitionBy("outcome")
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"processingTime": "10 seconds"}))
        .start(path)
    )


def read_checked(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(CHECKED).parquet(path)


def stream_checked(spark: SparkSession, path: str, max_files: int | None = None) -> DataFrame:
    reader = spark.readStream.schema(CHECKED)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.parquet(path)


def write_first_visits(
    events: DataFrame,
    path: str,
    checkpoint: str,
    trigger: dict | None = None,
    stream: str = "main",
) -> StreamingQuery:
    """Keep the earliest event of every (account, merchant) pair, as a stream.

    The known pairs are the state of a streaming minimum, looked up by key, so a micro-batch costs
    what it brings and not what is already known. Every pair that a batch touches is written with its
    first and its newest event. A table for other readers; the hot path keeps its own state
    (``visits.flag_new_merchants``). Use the RocksDB state store.
    """
    event = F.struct("event_timestamp", "event_id")
    firsts = events.groupBy("account_id", "merchant_id").agg(
        F.min(event).alias("first"), F.max(event).alias("seen")
    )

    def keep(batch: DataFrame, batch_id: int) -> None:
        create_log(batch.sparkSession, path, VISIT)
        rows = batch.select(
            "account_id",
            "merchant_id",
            "first.event_id",
            "first.event_timestamp",
            F.col("seen.event_timestamp").alias("seen_at"),
            F.col("seen.event_id").alias("seen_event_id"),
        )
        append_batch(rows, path, batch_id, stream=stream)

    return process_stream(firsts, keep, checkpoint, trigger, output_mode="update")


def earliest_visits(rows: DataFrame) -> DataFrame:
    """One row per pair. Also the fold with which to compact the log."""
    seen = ["seen_at", "seen_event_id"]
    rest = [c for c in rows.columns if c not in ("account_id", "merchant_id", *seen)]
    first = F.min_by(F.struct(*rest), F.struct("event_timestamp", "event_id")).alias("v")
    earliest = rows.groupBy("account_id", "merchant_id").agg(
        first, F.max(F.struct(*seen)).alias("s")
    )
    return earliest.select("account_id", "merchant_id", "v.*", "s.*").select(rows.columns)


def read_first_visits(spark: SparkSession, path: str, since=None) -> DataFrame:
    rows = earliest_visits(read_log(spark, path, VISIT)).drop("batch_id")
    return rows if since is None else rows.where(F.col("event_timestamp").cast("date") >= day(since))


def process_stream(
    stream: DataFrame,
    handler: Handler,
    checkpoint: str,
    trigger: dict | None = None,
    output_mode: str = "append",
) -> StreamingQuery:
    """Call ``handler(batch, batch_id)`` for every micro-batch."""
    return (
        stream.writeStream.foreachBatch(handler)
        .outputMode(output_mode)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"processingTime": "10 seconds"}))
        .start()
    )


def with_retries(
    handler: Handler,
    dead_path: str,
    max_retries: int = 3,
    delay_seconds: float = 1.0,
) -> Handler:
    """Retry a failing handler with growing pauses; then only the messages that fail are set aside.

    The batch is stored once, so attempts don't compute it again. After the last attempt it is
    halved by a 64-bit hash of its messages, at most 64 times over, until each failing message is
    alone; only these go to the dead letters. That takes about 2 * log2(messages / failing) + 2 calls
    for each failing message, so two for every message if all fail. The handler is called a last time
    with all others, so one that writes by batch id ends with exactly these. The batch must carry
    ``value`` and may carry topic, partition and offset; messages alike in all of them are one. The
    stream goes on.
    """

    def run(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        work = run_dir(spark, "retry")
        try:
            settle(batch, batch_id, work)
        finally:
            remove_path(spark, work)

    def settle(batch: DataFrame, batch_id: int, work: str) -> None:
        spark = batch.sparkSession
        position = [c for c in ("value", "topic", "partition", "offset") if c in batch.columns]
        batch.withColumn("_part", F.xxhash64(*position)).write.parquet(work)
        rows = spark.read.parquet(work)

        def attempt(part: DataFrame, times: int) -> str:
            error = ""
            for n in range(1, times + 1):
                try:
                    handler(part.drop("_part"), batch_id)
                    return ""
                except Exception as e:
                    error = f"{type(e).__name__}: {e}"
                    if n < times:
                        time.sleep(delay_seconds * n)
            return error

        error = attempt(rows, max_retries)
        if error:
            rest = rows
            bad = _failing(rows, attempt, error)
            if bad:
                failed_at = datetime.now(timezone.utc).replace(tzinfo=None)
                failing = spark.createDataFrame(bad, "_part long, _why string")
                about = F.create_map(F.lit("error"), F.col("_why"))
                dead = envelope(
                    rows.join(failing, "_part"), F.lit(EXHAUSTED), failed_at, metadata=about
                )
                append_batch(dead, dead_path, batch_id, sort_by=None)
                rest = rows.join(failing, "_part", "left_anti")
            if not rest.isEmpty():
                again = attempt(rest, max_retries)
                if again:  # fails only together: none of it can be kept
                    raise RuntimeError(f"batch {batch_id} fails as a whole: {again}")

    return run


def _failing(
    rows: DataFrame, attempt: Callable[[DataFrame, int], str], error: str
) -> list[tuple[int, str]]:
    """``_part`` and error of each message that fails alone."""
    todo = [(-(1 << 63), (1 << 63) - 1, error)]
    bad: list[tuple[int, str]] = []
    while todo:
        low, high, why = todo.pop()
        inside = rows.where(F.col("_part").between(low, high))
        span = inside.agg(F.min("_part").alias("low"), F.max("_part").alias("high")).first()
        if span["low"] == span["high"]:
            bad.append((span["low"], why))
            continue
        middle = (span["low"] + span["high"]) // 2
        for a, b in ((span["low"], middle), (middle + 1, span["high"])):
            found = attempt(rows.where(F.col("_part").between(a, b)), 1)
            if found:
                todo.append((a, b, found))
    return bad


def stop_after(query: StreamingQuery, max_messages: int, poll_seconds: float = 0.5) -> int:
    """Let a stream run until it has taken in at least ``max_messages``, then stop it.

    The cap is looked at between micro-batches, so the last batch is always whole. Returns the
    number of messages taken in.
    """
    taken: dict[int, int] = {}
    while True:
        active = query.isActive
        for progress in query.recentProgress:
            taken[progress["batchId"]] = progress["numInputRows"]
        if sum(taken.values()) >= max_messages or not active:
            break
        time.sleep(poll_seconds)
    query.stop()
    return sum(taken.values())
