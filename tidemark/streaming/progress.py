"""What every trigger took in, dropped and held, as a table."""

from __future__ import annotations

import threading
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQueryListener

from tidemark.sources.logs import path_exists

PROGRESS = T.StructType(
    [
        T.StructField("query_id", T.StringType()),
        T.StructField("batch_id", T.LongType()),
        T.StructField("run_id", T.StringType()),
        T.StructField("query_name", T.StringType()),
        T.StructField("triggered_at", T.TimestampNTZType()),
        T.StructField("rows_in", T.LongType()),
        T.StructField("rows_late", T.LongType()),
        T.StructField("state_rows", T.LongType()),
        T.StructField("state_bytes", T.LongType()),
        T.StructField("trigger_ms", T.LongType()),
    ]
)


class ProgressTable(StreamingQueryListener):
    """Writes a row per trigger under query and batch id, so that a trigger told twice is one row.

    ``rows_late`` are rows that a stateful operator dropped for the watermark; an aggregation counts them
    after its own pre-aggregation, deduplication counts each.
    """

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path
        self.ended: set[str] = set()
        self.changed = threading.Condition()
        self.error: str | None = None

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        try:
            self._write(event.progress)
        except Exception as e:  # a listener must not break its bus; recorded() raises it
            self.error = f"{type(e).__name__}: {e}"

    def onQueryTerminated(self, event) -> None:
        with self.changed:
            self.ended.add(str(event.runId))
            self.changed.notify_all()

    def _write(self, p) -> None:
        states = p.stateOperators
        row = (
            str(p.id), int(p.batchId), str(p.runId), p.name, p.timestamp, int(p.numInputRows),
            sum(s.numRowsDroppedByWatermark for s in states),
            sum(s.numRowsTotal for s in states),
            sum(s.memoryUsedBytes for s in states),
            int(p.durationMs.get("triggerExecution", 0)),
        )
        told = T.StructType(
            [T.StructField(f.name, T.StringType() if f.name == "triggered_at" else f.dataType) for f in PROGRESS]
        )
        at = F.to_timestamp_ntz(F.substring("triggered_at", 1, 19), F.lit("yyyy-MM-dd'T'HH:mm:ss"))
        (
            self.spark.createDataFrame([row], told)
            .withColumn("triggered_at", at)
            .coalesce(1)
            .write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy("query_id", "batch_id")
            .parquet(self.path)
        )

    def wait(self, run_ids: list[str], seconds: float) -> None:
        """Until the ends of these runs were told, and with them all of their triggers."""
        with self.changed:
            if not self.changed.wait_for(lambda: set(run_ids) <= self.ended, seconds):
                raise TimeoutError(f"no end of {sorted(set(run_ids) - self.ended)} was told")


@contextmanager
def recorded(spark: SparkSession, path: str, seconds: float = 60.0) -> Iterator[list[str]]:
    """Keep the progress of the streams that run within the block.

    Append the run id of each finished query to the list that is handed out, so that the block ends
    when their last triggers are stored.
    """
    table = ProgressTable(spark, path)
    spark.streams.addListener(table)
    runs: list[str] = []
    try:
        yield runs
        table.wait(runs, seconds)
    finally:
        spark.streams.removeListener(table)
    if table.error:
        raise RuntimeError(f"progress could not be stored: {table.error}")


def read_progress(spark: SparkSession, path: str) -> DataFrame:
    if not path_exists(spark, path):
        return spark.createDataFrame([], PROGRESS)
    return spark.read.schema(PROGRESS).parquet(path).select(*PROGRESS.names)


def delivery_report(progress: DataFrame, accepted: DataFrame) -> DataFrame:
    """One row: delivered, late and accepted rows, and whether they add up.

    ``accepted`` is one row with column accepted.
    """
    told = progress.agg(
        F.sum("rows_in").alias("delivered"), F.sum("rows_late").alias("late")
    )
    # One row beside one row.
    both = told.withColumn("accepted", accepted.scalar())
    return both.withColumn("complete", F.col("delivered") == F.col("late") + F.col("accepted"))
