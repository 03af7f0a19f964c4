"""Events kept once, however late they are delivered again.

Deduplication within the watermark forgets what it has seen, and a stream with a new checkpoint knows
nothing of the old one. Here the table of accepted events is its own ledger: it is parted by the day of
the event, and every micro-batch is anti-joined with the ids stored for its days. Only the id column of
those days is read. A batch that runs again doesn't count its own rows and replaces them.

    path/transaction_date=<day>/stream=<stream>/batch_id=<batch>

One stream at a time writes a table; files carry Bloom filters on the id for look-ups of single events.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from tidemark.sources.logs import path_exists
from tidemark.streaming.ingest import process_stream

_KEYS = [
    T.StructField("transaction_date", T.DateType()),
    T.StructField("stream", T.StringType()),
    T.StructField("batch_id", T.LongType()),
]


def _schema(events: T.StructType) -> T.StructType:
    own = [f for f in events if f.name not in {k.name for k in _KEYS}]
    return T.StructType([*own, *_KEYS])


def read_events(spark: SparkSession, path: str, events: T.StructType) -> DataFrame:
    """All accepted events with the stream and batch that brought them; none before the first batch."""
    if not path_exists(spark, path):
        return spark.createDataFrame([], _schema(events))
    return spark.read.schema(_schema(events)).parquet(path)


def find_events(spark: SparkSession, path: str, events: T.StructType, ids: list[str]) -> DataFrame:
    """The stored rows of a few ids; files whose Bloom filter rules them out are skipped."""
    return read_events(spark, path, events).where(F.col("event_id").isin(ids))


def append_new(batch: DataFrame, path: str, batch_id: int, stream: str) -> None:
    """Store the events of a batch whose ids the table doesn't have yet, each once.

    ``batch`` has event_id and event_timestamp. Repeats within the batch leave the row that comes first
    by time and content; an id that comes again with another day is another event.
    """
    spark = batch.sparkSession
    days = batch.withColumn("transaction_date", F.col("event_timestamp").cast("date"))
    columns = [f.name for f in _schema(days.schema) if f.name not in ("stream", "batch_id")]
    rest = [c for c in columns if c not in ("event_id", "transaction_date")]
    first = F.min_by(F.struct(*rest), F.struct("event_timestamp", F.xxhash64(*rest)))
    once = (
        days.groupBy("event_id", "transaction_date").agg(first.alias("v"))
        .select("event_id", "transaction_date", "v.*")
    )
    if path_exists(spark, path):
        # Two dates reach the driver; they name the folders that are read.
        span = days.agg(F.min("transaction_date").alias("a"), F.max("transaction_date").alias("b")).first()
        if span["a"] is None:
            return
        known = (
            spark.read.schema(_schema(batch.schema))
            .parquet(path)
            .where(F.col("transaction_date").between(F.lit(span["a"]), F.lit(span["b"])))
            .where((F.col("stream") != stream) | (F.col("batch_id") != batch_id))
            .select("event_id", "transaction_date")
        )
        once = once.join(known, ["event_id", "transaction_date"], "left_anti")
    (
        once.withColumns({"stream": F.lit(stream), "batch_id": F.lit(batch_id).cast("bigint")})
        .sortWithinPartitions("transaction_date", "event_id")
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .option("parquet.bloom.filter.enabled#event_id", "true")
        .partitionBy("transaction_date", "stream", "batch_id")
        .parquet(path)
    )


def write_once(
    events: DataFrame, path: str, checkpoint: str, stream: str = "main", trigger: dict | None = None
) -> StreamingQuery:
    """Keep a stream's events once; give a stream with a new checkpoint a name of its own."""

    def keep(batch: DataFrame, batch_id: int) -> None:
        append_new(batch, path, batch_id, stream)

    return process_stream(events, keep, checkpoint, trigger)
