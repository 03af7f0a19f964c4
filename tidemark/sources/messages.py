"""Message stream in, message frame out."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.keys import TOPIC_PARTITIONS, route_partition
from tidemark.schemas import TRANSACTIONS_TOPIC

# Missing offsets stop the stream; skipping them has to be asked for.
READER_OPTIONS = {"failOnDataLoss": "true"}
MESSAGE_COLUMNS = ["key", "value", "topic", "partition", "offset"]


def read_transactions(spark: SparkSession, source_options: dict[str, str]) -> DataFrame:
    """The transactions topic as a streaming frame of key, value, topic, partition and offset.

    ``source_options`` needs ``kafka.bootstrap.servers`` and ``startingOffsets``, as a first run
    either takes or skips what is stored already; ``maxOffsetsPerTrigger`` bounds a micro-batch.
    The connector jar has to be on the session's classpath.
    """
    for needed in ("kafka.bootstrap.servers", "startingOffsets"):
        if needed not in source_options:
            raise ValueError(f"source option {needed} is required")
    options = {"subscribe": TRANSACTIONS_TOPIC, **READER_OPTIONS, **source_options}
    raw = spark.readStream.format("kafka").options(**options).load()
    return raw.select(
        F.col("key").cast("string"), F.col("value").cast("string"), "topic", "partition", "offset"
    )


def publish_frame(df: DataFrame, partitions: int = TOPIC_PARTITIONS) -> DataFrame:
    """Events as keyed messages for a sink that takes key, value and partition columns.

    The partition is a column, not a shuffle: the sink places each row, so one busy account never
    gathers in one Spark task. Validate first; the counts of valid and dead rows are the report.
    """
    return df.select(
        F.col("account_id").alias("key"),
        F.to_json(F.struct(*df.columns)).alias("value"),
        route_partition(F.col("account_id"), partitions).alias("partition"),
    )
