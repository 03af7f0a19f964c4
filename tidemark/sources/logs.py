"""Append-only Parquet logs: folders by stream and batch, safe to replay, compacted by a plain job.

A batch writes the partition ``log/stream=<s>/batch_id=<n>`` and replaces exactly that partition when
it runs again; a stream that starts anew has another id and replaces nothing of the old one.
Compaction is a Spark job over two tables: it writes all rows as few large files to
``compacted/<n>/rows`` and the files it has taken in, as rows, to ``compacted/<n>/taken``. Spark gives
every write files of new names, so readers take the newest compacted rows, without the batches that
were written again since, and the log's files that are not among the taken ones: two anti joins, and
nothing of it on the driver. An old date, a rerun or a low batch id is visible after compaction like
any other. Nothing is rewritten in place, and a lost executor or a failed job leaves what was readable.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

_BATCH = ["stream", "batch_id"]
_FILE = [*_BATCH, "file"]
_TAKEN = "stream string, batch_id bigint, file string"


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether anything is stored there; a path that can't be looked at raises."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()).exists(where)


def remove_path(spark: SparkSession, path: str) -> None:
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)


def create_log(spark: SparkSession, path: str, schema: T.StructType) -> None:
    """Make an empty log, so that readers may come before the first batch; nothing if it exists."""
    if path_exists(spark, f"{path}/log"):
        return
    empty = spark.createDataFrame([], _keyed(schema))
    empty.write.mode("append").partitionBy(*_BATCH).parquet(f"{path}/log")


def with_batch(schema: T.StructType) -> T.StructType:
    rest = [f for f in schema if f.name not in _BATCH]
    return T.StructType([*rest, T.StructField("batch_id", T.LongType())])


def _keyed(schema: T.StructType) -> T.StructType:
    rest = [f for f in schema if f.name not in _BATCH]
    # Stream ids and batch ids are folder names; their types come from here.
    keys = [T.StructField("stream", T.StringType()), T.StructField("batch_id", T.LongType())]
    return T.StructType([*rest, *keys])


def append_batch(
    df: DataFrame,
    path: str,
    batch_id: int,
    sort_by: str | None = "account_id",
    stream: str = "main",
) -> int:
    """Write one batch of a stream and return its row count, taken while writing."""
    seen = Observation()
    rows = df.withColumns(
        {
            "stream": F.lit(stream),
            "batch_id": F.lit(batch_id).cast("bigint"),
        }
    )
    if sort_by:
        rows = rows.sortWithinPartitions(sort_by)
    (
        rows.observe(seen, F.count(F.lit(1)).alias("n"))
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*_BATCH)
        .parquet(f"{path}/log")
    )
    return seen.get["n"]


def read_batch(
    spark: SparkSession, path: str, schema: T.StructType, batch_id: int, stream: str = "main"
) -> DataFrame:
    """The rows of one batch, from its own folder."""
    rows = spark.read.schema(schema).parquet(f"{path}/log/stream={stream}/batch_id={batch_id}")
    return rows.select(*[f.name for f in schema])


def _newest(spark: SparkSession, path: str) -> int | None:
    """The number of the newest compaction that was written whole."""
    where = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/compacted/*/taken/_SUCCESS")
    found = where.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(where)
    steps = [int(f.getPath().getParent().getParent().getName()) for f in found or []]
    return max(steps, default=None)


def _taken(spark: SparkSession, path: str, step: int) -> DataFrame:
    return spark.read.schema(_TAKEN).parquet(f"{path}/compacted/{step}/taken")


def _log(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """The log's rows with their files; what is listed now is what the frame reads, always."""
    rows = spark.read.schema(_keyed(schema)).parquet(f"{path}/log")
    return rows.withColumn("file", F.col("_metadata.file_name"))


def _all_rows(log: DataFrame, path: str, schema: T.StructType, step: int | None) -> DataFrame:
    if step is None:
        return log.drop("file")
    spark = log.sparkSession
    fresh = log.join(_taken(spark, path, step), _FILE, "left_anti")
    again = fresh.select(*_BATCH).distinct()
    compacted = spark.read.schema(_keyed(schema)).parquet(f"{path}/compacted/{step}/rows")
    return compacted.join(again, _BATCH, "left_anti").unionByName(fresh.drop("file"))


def read_log(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """All rows. A log that was never created has none; one that can't be read raises."""
    if not path_exists(spark, f"{path}/log"):
        return spark.createDataFrame([], with_batch(schema))
    # Looked up before the log is listed: a batch that comes in between is then in the log.
    step = _newest(spark, path)
    rows = _all_rows(_log(spark, path, schema), path, schema, step)
    return rows.select(*[f.name for f in with_batch(schema)])


def compact(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    fold: Callable[[DataFrame], DataFrame] | None = None,
    files: int | None = None,
) -> str | None:
    """Write all rows as few large files, range-partitioned and sorted by account.

    ``fold`` may drop rows on the way (superseded, expired or deleted ones) and keeps the columns.
    Range partitioning on (account_id, batch_id) also splits an account that fills many files.
    Batches that arrive meanwhile stay in the log; one that is written again meanwhile ends the job
    without effect. Returns the folder of the rows, or None for an empty log.
    """
    step = _newest(spark, path)
    log = _log(spark, path, schema)
    if step is None and log.isEmpty():
        return None
    rows = _all_rows(log, path, schema, step)
    if fold is not None:
        rows = fold(rows)
    target = f"{path}/compacted/{0 if step is None else step + 1}"
    keys = [F.col("account_id"), F.col("batch_id")]
    parted = rows.repartitionByRange(files, *keys) if files else rows.repartitionByRange(*keys)
    parted = parted.sortWithinPartitions("account_id", "batch_id")
    parted.write.mode("overwrite").parquet(f"{target}/rows")
    # Written last: a compaction counts once its taken files are known.
    log.select(*_FILE).distinct().write.mode("overwrite").parquet(f"{target}/taken")
    return f"{target}/rows"


def remove_folded(spark: SparkSession, path: str) -> int:
    """Delete batches that the newest compaction has taken in, and older ones; returns how many batches.

    Run it when no reader is left that began before the last compaction. A batch that was written
    again since has other files and stays.
    """
    step = _newest(spark, path)
    if step is None:
        return 0
    stored = _log(spark, path, T.StructType([])).select(*_FILE).distinct()
    folded = stored.join(_taken(spark, path, step), _FILE, "left_semi").select(*_BATCH).distinct()
    n = 0
    for batch in folded.toLocalIterator():  # one folder each
        remove_path(spark, f"{path}/log/stream={batch['stream']}/batch_id={batch['batch_id']}")
        n += 1
    for earlier in range(step):
        remove_path(spark, f"{path}/compacted/{earlier}")
    return n
