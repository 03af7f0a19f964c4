"""Versioned feature snapshots: an append-only log with commit columns, and time travel over it."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.clock import MICROS, micros, wall
from tidemark.sources.logs import compact, remove_folded

COMMIT_COLUMNS = ["snapshot_id", "batch_id", "committed_at"]
_SLICE = 300 * MICROS


def stamp(
    df: DataFrame, batch_id: int | Column, committed_at: datetime | str | Column
) -> DataFrame:
    """Add the commit columns; snapshot ids follow commit time, so they are ordered and repeatable."""
    return df.withColumns(
        {
            "committed_at": wall(committed_at),
            "snapshot_id": micros(wall(committed_at)),
            "batch_id": (batch_id if isinstance(batch_id, Column) else F.lit(batch_id)).cast(
                "bigint"
            ),
        }
    )


def features_asof(
    snaps: DataFrame,
    requests: DataFrame,
    now: datetime | str | Column | None = None,
    max_lookback_days: int | None = None,
    slice_micros: int = _SLICE,
) -> DataFrame:
    """For every request (account_id, as_of, and any columns of its own) the features as they stood.

    Of the rows committed by ``as_of``, the one with the newest computed_at counts, then the newest
    commit. Requests without any such row come back with NULL features. With ``now`` and
    ``max_lookback_days``, requests older than that find nothing.

    Requests and snapshots are merged in time order and a running maximum carries the answer, so
    rows are never multiplied by a join. Time is cut into slices: groups are (account, slice), and
    each slice starts from the best row of all earlier slices, found on one row per slice.
    ``slice_micros`` has no effect on results: shorter slices make smaller groups and more of them.
    """
    own = [c for c in requests.columns if c not in ("account_id", "as_of")]
    payload = [c for c in snaps.columns if c != "account_id"]
    body = F.struct(*[F.col(c) for c in payload])
    rank = F.struct("computed_at", "snapshot_id")
    request = F.struct(*[F.col(c) for c in ["as_of", *own]])

    at = micros(F.col("committed_at"))
    logged = snaps.select(
        "account_id",
        F.floor(at / slice_micros).alias("slice"),
        at.alias("at"),
        rank.alias("rank"),
        body.alias("body"),
    )
    asked_at = micros(F.col("as_of"))
    asked = requests.select(
        "account_id",
        F.floor(asked_at / slice_micros).alias("slice"),
        asked_at.alias("at"),
        request.alias("request"),
    )
    # Best row of each slice, then the best over the slices before it.
    per_slice = (
        logged.groupBy("account_id", "slice")
        .agg(F.max("rank").alias("rank"), F.max_by("body", "rank").alias("body"))
        .withColumn("asked", F.lit(False))
    )
    asked_slices = asked.select("account_id", "slice").distinct().withColumn("asked", F.lit(True))
    earlier = (
        Window.partitionBy("account_id")
        .orderBy("slice")
        .rangeBetween(Window.unboundedPreceding, -1)
    )
    carried = (
        per_slice.unionByName(asked_slices, allowMissingColumns=True)
        .select(
            "account_id",
            "slice",
            "asked",
            F.max("rank").over(earlier).alias("rank"),
            F.max_by("body", "rank").over(earlier).alias("body"),
        )
        .where(F.col("asked") & F.col("rank").isNotNull())
        .select("account_id", "slice", (F.col("slice") * slice_micros).alias("at"), "rank", "body")
    )
    merged = logged.unionByName(carried).unionByName(asked, allowMissingColumns=True)
    until = (
        Window.partitionBy("account_id", "slice")
        .orderBy("at")
        .rangeBetween(Window.unboundedPreceding, Window.currentRow)
    )
    found = merged.select(
        "account_id", "request", F.max_by("body", "rank").over(until).alias("body")
    ).where(F.col("request").isNotNull())
    if now is not None and max_lookback_days is not None:
        oldest = wall(now) - F.expr(f"INTERVAL {int(max_lookback_days)} DAYS")
        found = found.withColumn("body", F.when(F.col("request.as_of") >= oldest, F.col("body")))
    return found.select(
        "account_id",
        *[F.col(f"request.{c}").alias(c) for c in ["as_of", *own]],
        *[F.col(f"body.{c}").alias(c) for c in payload],
    )


def features_at(
    snaps: DataFrame, as_of: datetime | str | Column, account_id: str | None = None
) -> DataFrame:
    """The features of one account, or of all, at one moment; accounts without any are absent."""
    visible = snaps.where(F.col("committed_at") <= wall(as_of))
    if account_id is not None:
        visible = visible.where(F.col("account_id") == account_id)
    payload = [c for c in snaps.columns if c != "account_id"]
    newest = F.max_by(F.struct(*payload), F.struct("computed_at", "snapshot_id"))
    return visible.groupBy("account_id").agg(newest.alias("v")).select("account_id", "v.*")


def feature_history(
    snaps: DataFrame,
    start: datetime | str | Column,
    end: datetime | str | Column,
    account_id: str | None = None,
) -> DataFrame:
    """All snapshot rows computed in [start, end], in time order per account."""
    rows = snaps.where(F.col("computed_at").between(wall(start), wall(end)))
    if account_id is not None:
        rows = rows.where(F.col("account_id") == account_id)
    return rows.orderBy("account_id", "computed_at", "snapshot_id")


def feature_diff(
    snaps: DataFrame, pairs: DataFrame, include_computed_at: bool = False
) -> DataFrame:
    """What changed per (account_id, timestamp_a, timestamp_b): one row per changed feature.

    Pairs with no snapshot on either side give nothing. Booleans count as 0 and 1 in the delta.
    """
    pairs = pairs.select("account_id", "timestamp_a", "timestamp_b").distinct()
    sides = pairs.select(
        "account_id",
        "timestamp_a",
        "timestamp_b",
        F.explode(
            F.array(
                F.struct(F.lit("a").alias("side"), F.col("timestamp_a").alias("as_of")),
                F.struct(F.lit("b").alias("side"), F.col("timestamp_b").alias("as_of")),
            )
        ).alias("s"),
    ).select("account_id", "timestamp_a", "timestamp_b", "s.side", "s.as_of")
    skip = {"account_id", *COMMIT_COLUMNS} | (set() if include_computed_at else {"computed_at"})
    features = [f for f in snaps.schema if f.name not in skip]
    looked_up = features_asof(snaps, sides)
    row = F.struct(*[f.name for f in features])
    found = F.col("snapshot_id").isNotNull()
    wide = (
        looked_up.where(found)
        .groupBy("account_id", "timestamp_a", "timestamp_b")
        .agg(
            F.max(F.when(F.col("side") == "a", row)).alias("a"),
            F.max(F.when(F.col("side") == "b", row)).alias("b"),
        )
        .where(F.col("a").isNotNull() & F.col("b").isNotNull())
    )

    def number(column: str, kind: T.DataType) -> Column:
        if isinstance(kind, T.BooleanType):
            return F.col(column).cast("int").cast("double")
        if isinstance(kind, T.NumericType):
            return F.col(column).cast("double")
        return F.lit(None).cast("double")

    changes = F.array(
        *[
            F.struct(
                F.lit(f.name).alias("feature"),
                F.col(f"a.{f.name}").cast("string").alias("before"),
                F.col(f"b.{f.name}").cast("string").alias("after"),
                (number(f"b.{f.name}", f.dataType) - number(f"a.{f.name}", f.dataType)).alias(
                    "delta"
                ),
                (~F.col(f"a.{f.name}").eqNullSafe(F.col(f"b.{f.name}"))).alias("changed"),
            )
            for f in features
        ]
    )
    return (
        wide.select("account_id", "timestamp_a", "timestamp_b", F.inline(changes))
        .where("changed")
        .drop("changed")
    )


def commits(snaps: DataFrame) -> DataFrame:
    """One row per commit."""
    return snaps.groupBy("snapshot_id", "committed_at").agg(F.count(F.lit(1)).alias("num_rows"))


def snapshots_to_expire(
    commits_: DataFrame,
    now: datetime | str | Column,
    max_age_days: int = 30,
    keep: int = 10,
) -> DataFrame:
    """Commits older than the age limit that are not among the newest ``keep``."""
    limit = wall(now) - F.expr(f"INTERVAL {int(max_age_days)} DAYS")
    newest = (
        commits_.orderBy(F.col("committed_at").desc(), F.col("snapshot_id").desc())
        .limit(keep)
        .select("snapshot_id")
    )
    return commits_.where(F.col("committed_at") < limit).join(newest, "snapshot_id", "left_anti")


def expire_snapshots(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    now: datetime | str | Column,
    max_age_days: int = 30,
    keep: int = 10,
) -> str | None:
    """Rewrite a snapshot log without its expired commits and delete the files that held them.

    Time travel to before the oldest commit left finds nothing. Run it when no reader is left that
    began before. Returns the new location, or None for an empty log.
    """

    def fold(rows: DataFrame) -> DataFrame:
        old = snapshots_to_expire(commits(rows), now, max_age_days, keep).select("snapshot_id")
        return rows.join(old, "snapshot_id", "left_anti").select(rows.columns)

    location = compact(spark, path, schema, fold)
    remove_folded(spark, path)
    return location
