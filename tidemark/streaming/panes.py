"""Hot path: event stream to ten-second panes, panes to served realtime features and snapshots."""

from __future__ import annotations

import time
from collections.abc import Callable
from dataclasses import dataclass
from datetime import datetime, timezone

from pyspark.sql import DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark import schemas as S
from tidemark.operators.hopping import (
    HOUR_SECONDS,
    LAST_COLUMNS,
    SLIDE_SECONDS,
    pane_aggregates,
    realtime_rows,
    windows_over,
)
from tidemark.operators.serving import upsert
from tidemark.operators.snapshots import stamp
from tidemark.operators.trailing import distance_from_home
from tidemark.sources.logs import append_batch, create_log, read_batch

WATERMARK = "30 seconds"
FLAG = ("is_new_merchant",)
BLOCK_SECONDS = 6 * HOUR_SECONDS  # of pane ends in one folder
PAST_WRITERS = 2  # tasks that write a block which is over; all tasks write the current ones

_LAST_TYPES = {f.name: f.dataType for f in S.TRANSACTION}
PANE = T.StructType(
    [
        T.StructField("account_id", T.StringType()),
        T.StructField("pane_end", T.LongType()),
        T.StructField("n", T.LongType()),
        T.StructField("amount_sum", T.DoubleType()),
        T.StructField("amount_max", T.DoubleType()),
        T.StructField(
            "newest",
            T.StructType(
                [
                    *[T.StructField(c, _LAST_TYPES[c]) for c in LAST_COLUMNS],
                    T.StructField("event_timestamp", T.TimestampType()),
                    T.StructField("event_id", T.StringType()),
                    # Only panes of flagged events have it.
                    T.StructField("is_new_merchant", T.BooleanType()),
                ]
            ),
        ),
        T.StructField("written_us", T.LongType()),
        T.StructField("pane_block", T.LongType()),
        T.StructField("stream", T.StringType()),
        T.StructField("batch_id", T.LongType()),
    ]
)
SNAPSHOT = T.StructType(
    [
        *S.REALTIME.fields,
        T.StructField("committed_at", T.TimestampNTZType()),
        T.StructField("snapshot_id", T.LongType()),
    ]
)
RUN = T.StructType(
    [
        T.StructField("rows_in", T.LongType()),
        T.StructField("features_written", T.LongType()),
        T.StructField("latency_ms", T.DoubleType()),
        T.StructField("snapshot_error", T.StringType()),
    ]
)


def dedupe_stream(events: DataFrame, watermark: str = WATERMARK) -> DataFrame:
    """Set the watermark and drop repeats of an event_id that arrive within it."""
    return _watermarked(events, watermark).dropDuplicatesWithinWatermark(["event_id"])


def _watermarked(events: DataFrame, watermark: str) -> DataFrame:
    timed = events.withColumn("event_timestamp", F.col("event_timestamp").cast("timestamp"))
    return timed.withWatermark("event_timestamp", watermark)


def pane_stream(
    events: DataFrame,
    watermark: str = WATERMARK,
    slide: int = SLIDE_SECONDS,
    dedupe: bool = False,
    flagged: bool = False,
) -> DataFrame:
    """Streaming panes per account; rows later than the watermark are dropped by Spark.

    ``flagged`` events bring ``is_new_merchant``, which goes with the newest event of a pane.

    In update mode a pane comes again, whole, when it changes. State holds only open panes, and with
    ``dedupe`` the event ids seen within the watermark.
    """
    timed = dedupe_stream(events, watermark) if dedupe else _watermarked(events, watermark)
    pane = F.window("event_timestamp", f"{slide} seconds")
    return (
        timed.groupBy("account_id", pane.alias("pane"))
        .agg(*pane_aggregates(FLAG if flagged else ()))
        .select(
            "account_id",
            F.unix_seconds("pane.end").alias("pane_end"),
            "n",
            "amount_sum",
            "amount_max",
            "newest",
        )
    )


def write_panes(panes: DataFrame, path: str, batch_id: int, stream: str = "main") -> dict:
    """Store a micro-batch of panes; a replay replaces its own partitions and nothing else.

    Folders are blocks of a few hours of pane ends, then streams and batches, so that a trigger lists
    the one or two blocks it needs and nothing else that was ever written. Rows are dealt by block
    before they are written: a backlog of many blocks would otherwise be a file for every task and
    block. Returns the row count and the range of pane ends, taken while writing.
    """
    seen = Observation()
    width = int(panes.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    current = int(time.time()) // BLOCK_SECONDS - 1
    writers = F.when(F.col("pane_block") >= current, width).otherwise(PAST_WRITERS)
    (
        panes.withColumns(
            {
                "written_us": F.lit(time.time_ns() // 1000),
                "pane_block": F.floor(F.col("pane_end") / BLOCK_SECONDS),
                "stream": F.lit(stream),
                "batch_id": F.lit(batch_id).cast("bigint"),
            }
        )
        .repartition("pane_block", F.pmod(F.xxhash64("account_id"), writers.cast("long")))
        .sortWithinPartitions("account_id", "pane_end")
        .observe(
            seen,
            F.count(F.lit(1)).alias("rows_in"),
            F.min("pane_end").alias("first"),
            F.max("pane_end").alias("last"),
        )
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("pane_block", "stream", "batch_id")
        .parquet(path)
    )
    return seen.get


LISTED_BLOCKS = 32  # up to so many folders are named one by one, else all are listed


def stored_panes(spark: SparkSession, path: str, blocks: range | None = None) -> DataFrame:
    """All versions of panes; ``blocks`` limits them, and what is listed, to those folders."""
    reader = spark.read.schema(PANE).option("basePath", path)
    if blocks is None:
        return reader.parquet(path)
    if len(blocks) > LISTED_BLOCKS:
        return reader.parquet(path).where(F.col("pane_block").between(blocks[0], blocks[-1]))
    return reader.parquet(f"{path}/pane_block={{{','.join(map(str, blocks))}}}")


def read_panes(spark: SparkSession, path: str, blocks: range | None = None) -> DataFrame:
    """The current content of every pane: the version that was written last."""
    columns = ["n", "amount_sum", "amount_max", "newest"]
    return (
        stored_panes(spark, path, blocks)
        .groupBy("account_id", "pane_end")
        .agg(F.max_by(F.struct(*columns), F.struct("written_us", "batch_id")).alias("p"))
        .select("account_id", "pane_end", "p.*")
    )


def fold_panes(spark: SparkSession, path: str, target: str, blocks: range) -> None:
    """Write the current panes of closed blocks as few files under ``target``, block by block.

    For blocks that no stream will touch again, as history for other readers; the hot path reads only
    the last hour and what a batch brings, so the folders of closed blocks may be dropped after it.
    """
    rows = read_panes(spark, path, blocks).withColumn(
        "pane_block", F.floor(F.col("pane_end") / BLOCK_SECONDS)
    )
    (
        rows.repartitionByRange("pane_block", "account_id")
        .sortWithinPartitions("account_id", "pane_end")
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("pane_block")
        .parquet(target)
    )


@dataclass
class Paths:
    """Where the hot path keeps its tables."""

    panes: str
    serving: str
    snapshots: str
    runs: str

    @classmethod
    def under(cls, root: str) -> Paths:
        return cls(
            panes=f"{root}/panes",
            serving=f"{root}/serving",
            snapshots=f"{root}/{S.REALTIME_SNAPSHOTS}",
            runs=f"{root}/runs",
        )


def _utc_now() -> datetime:
    return datetime.now(timezone.utc).replace(tzinfo=None)


def newest_windows(
    spark: SparkSession, path: str, batch_id: int, span: dict, stream: str = "main"
) -> DataFrame:
    """The window that ends with the newest pane, for every account the batch touched.

    Only the panes of the last hour are read; ``span`` is what write_panes returned.
    """
    own = stored_panes(spark, path, _blocks(span["first"], span["last"]))
    own = own.where((F.col("stream") == stream) & (F.col("batch_id") == batch_id))
    touched = own.select("account_id").distinct()
    # Up to the newest pane of any account: an hour ahead too, should all rows have been late.
    recent = read_panes(
        spark, path, _blocks(span["first"] - HOUR_SECONDS, span["last"] + HOUR_SECONDS)
    ).where(F.col("pane_end") > span["first"] - HOUR_SECONDS)
    windows = windows_over(recent.join(touched, "account_id", "left_semi"), carried=FLAG)
    newest_first = Window.partitionBy("account_id").orderBy(F.col("pane_end").desc())
    return (
        windows.withColumn("rank", F.row_number().over(newest_first))
        .where(F.col("rank") == 1)
        .drop("rank", "pane_end")
    )


def _blocks(first: int, last: int) -> range:
    return range(first // BLOCK_SECONDS, last // BLOCK_SECONDS + 1)


def make_sink(
    paths: Paths,
    profiles: DataFrame | None = None,
    clock: Callable[[], datetime] = _utc_now,
    mode: str = "shared",
    stream: str = "main",
) -> Callable[[DataFrame, int], None]:
    """The micro-batch function of the hot path: panes, serving rows, then a snapshot.

    Serving comes first. A failed snapshot does not fail the batch; its error is kept in the runs
    table. Everything is written under the stream's name and the batch id, so running a batch again
    changes nothing; give a stream with a new checkpoint a name of its own.
    Panes of flagged events (``visits.flag_new_merchants``) bring the newest event's flag along;
    without flags it is false.
    """

    def sink(batch: DataFrame, batch_id: int) -> None:
        started = time.monotonic()
        spark = batch.sparkSession
        # The stream is computed once, by this write; all else reads what it stored.
        span = write_panes(batch, paths.panes, batch_id, stream)
        if span["rows_in"] == 0:
            return
        windows = newest_windows(spark, paths.panes, batch_id, span, stream)
        if profiles is not None:
            located = windows.withColumnsRenamed(
                {"last_latitude": "latitude", "last_longitude": "longitude"}
            )
            windows = distance_from_home(located, profiles)
        now = clock()
        rows = realtime_rows(windows, now, mode)
        written = upsert(rows, "realtime", paths.serving, batch_id, now, stream=stream)
        error = None
        try:
            # The snapshot repeats exactly the rows that the batch put into serving.
            served = read_batch(spark, f"{paths.serving}/realtime", S.REALTIME, batch_id, stream)
            create_log(spark, paths.snapshots, SNAPSHOT)
            append_batch(
                stamp(served, batch_id, now), paths.snapshots, batch_id, stream=stream
            )
        except Exception as e:
            error = f"{type(e).__name__}: {e}"
        elapsed = (time.monotonic() - started) * 1000.0
        run = spark.createDataFrame([(span["rows_in"], written, elapsed, error)], RUN)
        create_log(spark, paths.runs, RUN)
        append_batch(run, paths.runs, batch_id, sort_by=None, stream=stream)

    return sink
