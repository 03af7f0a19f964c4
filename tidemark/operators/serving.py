"""Keyed serving rows with expiry: upsert, live view, merge of fresh and nightly features."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark import schemas as S
from tidemark.functions.clock import wall
from tidemark.functions.keys import KEY_PREFIX, serving_key
from tidemark.sources.logs import append_batch, compact, create_log, read_log

GROUPS = {
    "realtime": (S.REALTIME, S.REALTIME_TTL_SECONDS),
    "batch": (S.BATCH, S.BATCH_TTL_SECONDS),
}


def log_schema(group: str) -> T.StructType:
    return T.StructType(
        [
            *GROUPS[group][0].fields,
            T.StructField("written_at", T.TimestampNTZType()),
            T.StructField("expires_at", T.TimestampNTZType()),
            T.StructField("batch_id", T.LongType()),
        ]
    )


def serving_rows(
    df: DataFrame,
    group: str,
    written_at: datetime | str | Column,
    ttl_s: int | None = None,
    batch_id: int | Column = 0,
) -> DataFrame:
    """Feature rows of a group with their write and expiry times."""
    schema, default_ttl = GROUPS[group]
    ttl = default_ttl if ttl_s is None else ttl_s
    at = wall(written_at)
    return df.select(
        *[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema],
        at.alias("written_at"),
        (at + F.expr(f"INTERVAL {int(ttl)} SECONDS")).alias("expires_at"),
        (batch_id if isinstance(batch_id, Column) else F.lit(batch_id)).cast("bigint").alias(
            "batch_id"
        ),
    )


def upsert(
    df: DataFrame,
    group: str,
    path: str,
    batch_id: int,
    written_at: datetime | str | Column,
    ttl_s: int | None = None,
    stream: str = "main",
) -> int:
    """Write a batch of feature rows under its stream and batch id; returns how many were written.

    Realtime and batch rows live in separate folders, so neither path reads what the other writes.
    """
    create_log(df.sparkSession, f"{path}/{group}", log_schema(group))
    rows = serving_rows(df, group, written_at, ttl_s).drop("batch_id")
    return append_batch(rows, f"{path}/{group}", batch_id, stream=stream)


def read_serving(spark: SparkSession, path: str, group: str) -> DataFrame:
    return read_log(spark, f"{path}/{group}", log_schema(group))


def newest(serving: DataFrame) -> DataFrame:
    """The last written row per account, combined on the map side."""
    columns = [c for c in serving.columns if c != "account_id"]
    last = F.max_by(F.struct(*columns), F.struct("written_at", "batch_id"))
    return serving.groupBy("account_id").agg(last.alias("v")).select("account_id", "v.*")


def live(
    serving: DataFrame, now: datetime | str | Column, tombstones: DataFrame | None = None
) -> DataFrame:
    """What a reader sees at ``now``: the newest row per account, unless expired or deleted since.

    ``tombstones`` has account_id and deleted_at; a row written after the deletion is visible again.
    """
    rows = newest(serving.where(F.col("written_at") <= wall(now)))
    rows = rows.where(F.col("expires_at") > wall(now))
    if tombstones is None:
        return rows
    return without_deleted(rows, tombstones)


def without_deleted(serving: DataFrame, tombstones: DataFrame) -> DataFrame:
    deleted = tombstones.groupBy("account_id").agg(F.max("deleted_at").alias("deleted_at"))
    return (
        serving.join(deleted, "account_id", "left")
        .where(F.col("deleted_at").isNull() | (F.col("written_at") > F.col("deleted_at")))
        .drop("deleted_at")
    )


def delete_accounts(serving: DataFrame, accounts: DataFrame) -> DataFrame:
    """Serving rows without those of the given accounts."""
    return serving.join(accounts.select("account_id").distinct(), "account_id", "left_anti")


def compact_serving(
    spark: SparkSession,
    path: str,
    group: str,
    now: datetime | str | Column,
    tombstones: DataFrame | None = None,
) -> str | None:
    """Fold a group's log to the live rows; superseded, expired and deleted ones are left out.

    Rows written after ``now`` are carried over as they are.
    """

    def fold(rows: DataFrame) -> DataFrame:
        later = rows.where(F.col("written_at") > wall(now))
        return live(rows, now, tombstones).select(rows.columns).unionByName(later)

    return compact(spark, f"{path}/{group}", log_schema(group), fold)


TOMBSTONE = T.StructType(
    [
        T.StructField("account_id", T.StringType()),
        T.StructField("deleted_at", T.TimestampNTZType()),
    ]
)


def mark_deleted(
    accounts: DataFrame, path: str, batch_id: int, deleted_at: datetime | str | Column
) -> int:
    """Store a batch of deletions; they hide rows at once and compaction drops them."""
    create_log(accounts.sparkSession, f"{path}/tombstones", TOMBSTONE)
    marks = accounts.select("account_id", wall(deleted_at).alias("deleted_at")).distinct()
    return append_batch(marks, f"{path}/tombstones", batch_id)


def read_tombstones(spark: SparkSession, path: str) -> DataFrame:
    return read_log(spark, f"{path}/tombstones", TOMBSTONE).select("account_id", "deleted_at")


def feature_vectors(
    realtime: DataFrame, batch: DataFrame, served_at: datetime | str | Column
) -> DataFrame:
    """Both halves per account as structs; an account known to neither has no row."""
    served = wall(served_at)

    def packed(df: DataFrame, schema: T.StructType, name: str) -> DataFrame:
        return df.select("account_id", F.struct(*[f.name for f in schema]).alias(name))

    merged = packed(realtime, S.REALTIME, "realtime").join(
        packed(batch, S.BATCH, "batch"), "account_id", "full_outer"
    )

    def half(name: str, schema: T.StructType, defaults: dict) -> Column:
        parts = []
        for f in schema:
            value = F.col(f"{name}.{f.name}")
            if f.name == "account_id":
                value = F.col("account_id")
            elif f.name == "computed_at":
                value = F.coalesce(value, served)
            elif f.name in defaults:
                value = F.coalesce(value, F.lit(defaults[f.name]))
            parts.append(value.cast(f.dataType).alias(f.name))
        return F.struct(*parts).alias(name)

    return merged.select(
        "account_id",
        half("realtime", S.REALTIME, S.REALTIME_DEFAULTS),
        half("batch", S.BATCH, S.BATCH_DEFAULTS),
        served.alias("served_at"),
        F.lit(S.VECTOR_VERSION).alias("feature_store_version"),
    )


def model_input(vectors: DataFrame) -> DataFrame:
    """One flat row per account with every feature and no bookkeeping columns."""
    return vectors.select(
        *[F.col(f"realtime.{n}").alias(n) for n in S.REALTIME_FEATURES],
        *[F.col(f"batch.{n}").alias(n) for n in S.BATCH_FEATURES],
        "account_id",
    )


def key_values(df: DataFrame, group: str, prefix: str = KEY_PREFIX) -> DataFrame:
    """Feature rows as string keys and JSON values with a lifetime, for an external store."""
    schema, ttl = GROUPS[group]
    return df.select(
        serving_key(F.col("account_id"), F.lit(group), prefix).alias("key"),
        F.to_json(F.struct(*[f.name for f in schema]), {"ignoreNullFields": "false"}).alias("value"),
        F.lit(ttl).alias("ttl_seconds"),
    )


def from_key_values(rows: DataFrame, group: str) -> DataFrame:
    """Decode JSON values written by key_values."""
    schema, _ = GROUPS[group]
    return rows.select(F.from_json("value", schema).alias("v")).select("v.*")


def serving_keys(df: DataFrame, group: str, prefix: str = KEY_PREFIX) -> DataFrame:
    return df.select(
        "account_id", serving_key(F.col("account_id"), F.lit(group), prefix).alias("key")
    )
