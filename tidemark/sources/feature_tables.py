"""Feature tables on disk, and event files."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark import schemas as S
from tidemark.functions.clock import day
from tidemark.operators.validation import decode_parsed, valid_only
from tidemark.sources.logs import path_exists

_ROLLING_KEY = ["account_id", "computation_date", "window_days", "metric_name"]


def load_events(spark: SparkSession, path: str, one_array_per_file: bool = False) -> DataFrame:
    """Events from newline-delimited JSON, which Spark splits; bad lines are skipped.

    With ``one_array_per_file`` every file holds one array of objects. Such a file is one task.
    """
    records = spark.read.schema(S.MESSAGE).option("columnNameOfCorruptRecord", "_corrupt")
    rows = records.option("multiLine", one_array_per_file).json(path)
    return valid_rows(rows)


def load_event_lines(spark: SparkSession, path: str) -> DataFrame:
    return load_events(spark, path)


def valid_rows(records: DataFrame) -> DataFrame:
    """The rows of parsed messages that pass validation; the parsed columns are used as they are."""
    if "_corrupt" not in records.columns:
        records = records.withColumn("_corrupt", F.lit(None).cast("string"))
    return valid_only(decode_parsed(records))


def write_daily(df: DataFrame, path: str) -> None:
    """Replace the computation dates present in ``df`` and keep all others.

    Files hold adjoining accounts in order, so a lookup of an account skips most of them.
    """
    (
        df.repartitionByRange("computation_date", "account_id")
        .sortWithinPartitions("computation_date", "account_id")
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("computation_date")
        .parquet(path)
    )


def read_daily(spark: SparkSession, path: str, target_date: date | str) -> DataFrame:
    """One day's features, cast to the contract; rows that do not fit it are dropped."""
    dated = T.StructType([*S.BATCH.fields, T.StructField("computation_date", T.DateType())])
    table = spark.read.schema(dated).parquet(path)
    rows = table.where(F.col("computation_date") == day(target_date))
    return conform_batch(rows)


def conform_batch(rows: DataFrame) -> DataFrame:
    """Cast to the batch contract and drop rows with missing or impossible values."""
    cast = rows.select(*[F.col(f.name).try_cast(f.dataType).alias(f.name) for f in S.BATCH])
    whole = cast.dropna(subset=["account_id", *S.BATCH_FEATURES])
    return whole.where(F.col("pct_online_txns_30d").between(0.0, 1.0))


def append_rolling(
    spark: SparkSession,
    df: DataFrame,
    path: str,
    strict_forward: bool = False,
    dates: list[date | str] | None = None,
) -> None:
    """Append rolling metrics that the table does not have yet.

    By default rows whose four-column key exists are skipped, so reruns and backfills are safe.
    ``strict_forward`` keeps only dates after the newest one in the table; an empty table takes all.
    ``dates`` names the computation dates of ``df``, so that only those partitions are looked up.
    """
    if not path_exists(spark, path):
        empty = spark.createDataFrame([], S.ROLLING)
        empty.write.mode("append").partitionBy("computation_date").parquet(path)
    existing = spark.read.schema(S.ROLLING).parquet(path)
    if dates and not strict_forward:
        existing = existing.where(F.col("computation_date").isin([day(d) for d in dates]))
    fresh = new_rolling(df, existing, strict_forward)
    fresh.write.mode("append").partitionBy("computation_date").parquet(path)


def replace_rolling(df: DataFrame, path: str) -> None:
    """Replace the computation dates present in ``df``, so that a rerun follows corrected input."""
    (
        df.select(*S.ROLLING.names)
        .repartitionByRange("computation_date", "account_id")
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("computation_date")
        .parquet(path)
    )


def new_rolling(df: DataFrame, existing: DataFrame, strict_forward: bool = False) -> DataFrame:
    if strict_forward:
        newest = existing.agg(F.max("computation_date")).scalar()
        return df.where(newest.isNull() | (F.col("computation_date") > newest))
    return df.join(existing.select(*_ROLLING_KEY), _ROLLING_KEY, "left_anti")


def write_days(df: DataFrame, path: str) -> None:
    """Replace the transaction dates present in ``df`` and keep all others."""
    (
        df.repartitionByRange("transaction_date", "account_id")
        .sortWithinPartitions("transaction_date", "account_id")
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("transaction_date")
        .parquet(path)
    )


def write_totals(totals: DataFrame, path: str, target_date: date | str) -> DataFrame:
    """Keep a date's window totals, which two tables are built from, and read them back."""
    (
        totals.withColumn("computation_date", day(target_date))
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("computation_date")
        .parquet(path)
    )
    dated = T.StructType([*totals.schema.fields, T.StructField("computation_date", T.DateType())])
    stored = totals.sparkSession.read.schema(dated).parquet(path)
    return stored.where(F.col("computation_date") == day(target_date)).drop("computation_date")
