"""Session defaults and the shared working folder."""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession

# Settings the operators count on. AQE sizes the reduce side and splits hot join partitions;
# UTC keeps wall-clock timestamps and instants interchangeable.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Call sites are looked up for every Column otherwise, which costs more than planning does.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
    # Streaming state outgrows the heap; RocksDB keeps it on disk and uploads only what changed.
    "spark.sql.streaming.stateStore.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    ),
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}


def build_session(app: str = "tidemark", master: str | None = None, **extra: str) -> SparkSession:
    builder = SparkSession.builder.appName(app).config("spark.ui.enabled", "false")
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **extra}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def pin_utc(spark: SparkSession) -> SparkSession:
    """Make an existing session read and show timestamps in UTC."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


# State for few, large triggers. A changelog costs a write per row and is replayed row by row by every
# run that starts from it; a snapshot is files that are copied. Rows are not counted, which would look
# up every key once more before it is put: the progress of such a stream tells no state_rows.
BACKLOG_SETTINGS = {
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "false",
    "spark.sql.streaming.stateStore.rocksdb.trackTotalNumberOfRows": "false",
}


def stream_session(
    spark: SparkSession, state_partitions: int | None = None, backlog: bool = False
) -> SparkSession:
    """A session on the same cluster for stateful streams.

    The number of state partitions is fixed by a stream's first run, so it follows the cluster's
    cores (or the caller) and not the shuffle width that batch queries happen to use. ``backlog`` is
    for streams that take in much at once and start anew on what they hold.
    """
    session = pin_utc(spark.newSession())
    width = state_partitions or spark.sparkContext.defaultParallelism
    session.conf.set("spark.sql.shuffle.partitions", str(width))
    for key, value in SETTINGS.items():
        if "stateStore" in key:
            session.conf.set(key, value)
    if backlog:
        for key, value in BACKLOG_SETTINGS.items():
            session.conf.set(key, value)
    return session


def wide_session(spark: SparkSession, partitions: int = 1024) -> SparkSession:
    """A session on the same cluster for queries that multiply and sort rows.

    Shuffles start at many partitions, and adaptive execution merges them up to 16 MB, so a task sorts
    as much for a small table as for a large one and not a fixed share of all rows.
    """
    session = pin_utc(spark.newSession())
    width = int(spark.conf.get("spark.sql.shuffle.partitions"))
    session.conf.set("spark.sql.shuffle.partitions", str(width))
    start = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
    session.conf.set(start, str(max(width, partitions)))
    session.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "16m")
    return session


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach, as named by the cluster in spark.checkpoint.dir.

    Without that setting a local session uses a folder in its warehouse; on a cluster, where the
    warehouse may be a folder of one machine, its absence is an error.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named
    if not spark.conf.get("spark.master", "local").startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    return f"{spark.conf.get('spark.sql.warehouse.dir')}/tidemark-work"


def run_dir(spark: SparkSession, name: str) -> str:
    """A new folder for one run under the shared folder."""
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
