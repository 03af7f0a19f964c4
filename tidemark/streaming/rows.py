"""Handlers that work on rows: each failing message is set aside in the pass that finds it.

The handler takes an Arrow batch of checked events and returns one of its own. Where it raises, the
batch is halved within the task until the failing rows are alone, so bad messages cost handler calls
and never a Spark job, and all others are processed.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.streaming import StreamingQuery

from tidemark.operators.quality import EXHAUSTED
from tidemark.operators.validation import envelope
from tidemark.streaming.ingest import checked_rows, process_stream

RowHandler = Callable[[pa.RecordBatch], pa.RecordBatch]

_POSITION = ["source_topic", "source_partition", "source_offset"]


def attempt(
    handler: RowHandler, batch: pa.RecordBatch, max_retries: int, delay_seconds: float
) -> list[tuple[int, int, pa.RecordBatch | str, int]]:
    """(first row, rows, result or error, attempts) over the whole batch, in order.

    A batch is tried ``max_retries`` times with growing pauses before it is halved, and so is a row
    alone; the halves between are tried once.
    """
    done: list[tuple[int, int, pa.RecordBatch | str, int]] = []
    todo = [(0, batch.num_rows)]
    while todo:
        at, n = todo.pop()
        if not n:
            continue
        part = batch.slice(at, n)
        tries = max_retries if n in (1, batch.num_rows) else 1
        for k in range(1, tries + 1):
            try:
                result = handler(part)
                if result.num_rows != n:
                    raise ValueError(f"{result.num_rows} rows came back for {n}")
                done.append((at, n, result, k))
                break
            except Exception as e:
                error = f"{type(e).__name__}: {e}"
                if k < tries:
                    time.sleep(delay_seconds * k)
        else:
            if n == 1:
                done.append((at, n, error, tries))
            else:
                half = n // 2
                todo += [(at + half, n - half), (at, half)]
    return done


def handled(
    messages: DataFrame,
    handler: RowHandler,
    result: T.StructType,
    max_retries: int = 3,
    delay_seconds: float = 0.0,
) -> DataFrame:
    """One row per message: its outcome, the handler's columns, and for the others the reason.

    ``outcome`` is done, failed (the handler gave up on the row) or dead (the message breaks a rule and
    never reached it). One scan and one pass; works on streams and tables. The handler sees the
    columns of an event, source position and value, may be called again for rows it has already seen,
    and has to return as many rows as it gets, with the fields of ``result`` in their order.
    """
    rows = checked_rows(messages, keep_message=True).drop("checked_at")
    out = T.StructType(
        [
            T.StructField("outcome", T.StringType()),
            T.StructField("error", T.StringType()),
            T.StructField("attempts", T.IntegerType()),
            T.StructField("original_message", T.StringType()),
            *[rows.schema[n] for n in _POSITION],
            *result.fields,
        ]
    )
    arrow = to_arrow_schema(out)
    made = to_arrow_schema(result)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            outcome = batch.column("outcome")
            valid = pa.compute.equal(outcome, "valid")
            for taken, own in ((True, batch.filter(valid)), (False, batch.filter(pa.compute.invert(valid)))):
                if not own.num_rows:
                    continue
                kept = [own.column(n) for n in ("original_message", *_POSITION)]
                if not taken:
                    yield _rows(
                        ["dead"] * own.num_rows,
                        own.column("error_reason").to_pylist(),
                        [0] * own.num_rows,
                        kept,
                        [pa.nulls(own.num_rows, f.type) for f in made],
                    )
                    continue
                events = own.drop_columns(["outcome", "error_reason"])
                for at, n, got, tries in attempt(handler, events, max_retries, delay_seconds):
                    mine = [c.slice(at, n) for c in kept]
                    if isinstance(got, str):
                        values = [pa.nulls(n, f.type) for f in made]
                        yield _rows(["failed"] * n, [got] * n, [tries] * n, mine, values)
                    else:
                        values = [got.column(k).cast(f.type) for k, f in enumerate(made)]
                        mine[0] = pa.nulls(n, pa.string())  # only what failed keeps its text
                        yield _rows(["done"] * n, [None] * n, [tries] * n, mine, values)

    def _rows(outcome, error, attempts, kept, values) -> pa.RecordBatch:
        head = [
            pa.array(outcome, pa.string()),
            pa.array(error, pa.string()),
            pa.array(attempts, pa.int32()),
        ]
        columns = [c.cast(f.type) for c, f in zip([*head, *kept, *values], arrow)]
        return pa.RecordBatch.from_arrays(columns, arrow.names)

    return rows.mapInArrow(run, out)


def set_aside(rows: DataFrame, failed_at) -> DataFrame:
    """The dead letters of handled rows: broken messages with their rules, failed ones with the error."""
    bad = rows.where(F.col("outcome") != "done").select(
        F.col("original_message").alias("value"),
        F.col("source_topic").alias("topic"),
        F.col("source_partition").alias("partition"),
        F.col("source_offset").alias("offset"),
        "outcome",
        "error",
        "attempts",
    )
    failed = F.col("outcome") == "failed"
    about = F.when(
        failed,
        F.create_map(
            F.lit("error"), F.col("error"), F.lit("attempts"), F.col("attempts").cast("string")
        ),
    ).otherwise(F.create_map().cast("map<string,string>"))
    reason = F.when(failed, F.lit(EXHAUSTED)).otherwise(F.col("error"))
    return envelope(bad, reason, failed_at, metadata=about)


def write_handled(
    messages: DataFrame,
    handler: RowHandler,
    result: T.StructType,
    path: str,
    checkpoint: str,
    trigger: dict | None = None,
    max_retries: int = 3,
    delay_seconds: float = 1.0,
    stream: str = "main",
) -> StreamingQuery:
    """Run the handler over a stream of messages into one table, parted by stream, batch and outcome.

    Every micro-batch is one write, which replaces its own folders when the batch runs again.
    """

    def keep(batch: DataFrame, batch_id: int) -> None:
        write_batch(batch, handler, result, path, batch_id, max_retries, delay_seconds, stream)

    return process_stream(messages, keep, checkpoint, trigger)


def write_batch(
    messages: DataFrame,
    handler: RowHandler,
    result: T.StructType,
    path: str,
    batch_id: int,
    max_retries: int = 3,
    delay_seconds: float = 1.0,
    stream: str = "main",
) -> None:
    """The handled rows of one batch, as one Spark job whatever fails in it."""
    (
        handled(messages, handler, result, max_retries, delay_seconds)
        .withColumns({"stream": F.lit(stream), "batch_id": F.lit(batch_id).cast("bigint")})
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("stream", "batch_id", "outcome")
        .parquet(path)
    )


def read_handled(spark: SparkSession, path: str, result: T.StructType) -> DataFrame:
    """All handled rows; asking for one outcome reads its folders only."""
    schema = T.StructType(
        [
            T.StructField("error", T.StringType()),
            T.StructField("attempts", T.IntegerType()),
            T.StructField("original_message", T.StringType()),
            T.StructField("source_topic", T.StringType()),
            T.StructField("source_partition", T.IntegerType()),
            T.StructField("source_offset", T.LongType()),
            *result.fields,
            T.StructField("stream", T.StringType()),
            T.StructField("batch_id", T.LongType()),
            T.StructField("outcome", T.StringType()),
        ]
    )
    return spark.read.schema(schema).parquet(path)
