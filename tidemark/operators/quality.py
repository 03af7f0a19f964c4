"""Checks over features, dead letters and runs, as small result tables."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.clock import micros, wall

# Thresholds of the nightly check, and the reason given when a handler kept failing.
MIN_ACCOUNTS = 100
MIN_WRITTEN_RATIO = 0.95
EXHAUSTED = "Max retries exhausted"


def quality_gate(
    features: DataFrame,
    written: DataFrame | int,
    min_accounts: int = MIN_ACCOUNTS,
    min_ratio: float = MIN_WRITTEN_RATIO,
) -> DataFrame:
    """Three checks with status pass, warn or fail: enough accounts, enough written, valid ranges.

    ``written`` is the row count a serving write returned, or the written rows themselves.
    """
    ranged = F.col("pct_online_txns_30d").between(0.0, 1.0) & (F.col("txn_count_30d") >= 0)
    sides = features.select(
        F.lit(1).alias("f"), F.lit(0).alias("w"), F.when(ranged, 0).otherwise(1).alias("bad")
    )
    if isinstance(written, DataFrame):
        sides = sides.unionByName(
            written.select(F.lit(0).alias("f"), F.lit(1).alias("w"), F.lit(0).alias("bad"))
        )
    totals = sides.agg(
        *[F.coalesce(F.sum(c), F.lit(0)).cast("bigint").alias(c) for c in ("f", "w", "bad")]
    )
    if not isinstance(written, DataFrame):
        totals = totals.withColumn("w", F.lit(written).cast("bigint"))
    accounts, stored = F.col("f"), F.col("w")

    def check(name: str, observed: Column, threshold: Column, ok: Column, otherwise: str) -> Column:
        return F.struct(
            F.lit(name).alias("check_name"),
            observed.cast("double").alias("observed"),
            threshold.cast("double").alias("threshold"),
            F.when(ok, "pass").otherwise(otherwise).alias("status"),
        )

    floor = accounts * F.lit(min_ratio)
    return totals.select(
        F.inline(
            F.array(
                check(
                    "min_accounts", accounts, F.lit(min_accounts), accounts >= min_accounts, "warn"
                ),
                check("written_ratio", stored, floor, stored >= floor, "fail"),
                check("values_in_range", F.col("bad"), F.lit(0), F.col("bad") == 0, "fail"),
            )
        )
    )


def freshness(df: DataFrame, now: datetime | str | Column) -> DataFrame:
    """Age of every row's features in seconds."""
    age = (micros(wall(now)) - micros(F.col("computed_at"))) / F.lit(1_000_000.0)
    return df.select("account_id", "computed_at", age.alias("age_seconds"))


def freshness_summary(df: DataFrame, now: datetime | str | Column, group: str) -> DataFrame:
    return (
        freshness(df, now)
        .agg(
            F.count(F.lit(1)).alias("num_accounts"),
            F.min("age_seconds").alias("min_age_seconds"),
            F.max("age_seconds").alias("max_age_seconds"),
        )
        .select(F.lit(group).alias("feature_group"), "*")
    )


def dlq_depth(dead: DataFrame, threshold: int | None = None) -> DataFrame:
    """Dead letters per reason, and whether the number passes the alert threshold."""
    depth = dead.groupBy("error_reason").agg(F.count(F.lit(1)).alias("depth"))
    if threshold is None:
        return depth
    return depth.withColumn("alert", F.col("depth") > threshold)


def ingest_stats(valid: DataFrame, dead: DataFrame) -> DataFrame:
    """One row: processed, failed and dlq_routed. Failed are those a handler gave up on."""
    exhausted = F.col("error_reason") == EXHAUSTED
    outcomes = valid.select(F.lit("ok").alias("outcome")).unionByName(
        dead.select(F.when(exhausted, "failed").otherwise("invalid").alias("outcome"))
    )

    def n(*kinds: str) -> Column:
        return F.count(F.when(F.col("outcome").isin(*kinds), 1))

    return outcomes.agg(
        n("ok").alias("processed"),
        n("failed").alias("failed"),
        n("failed", "invalid").alias("dlq_routed"),
    )


def outcome_stats(handled: DataFrame) -> DataFrame:
    """One row of the same counts from handled messages (``streaming.rows``), in one scan."""

    def n(*kinds: str) -> Column:
        return F.count(F.when(F.col("outcome").isin(*kinds), 1))

    return handled.agg(
        n("done").alias("processed"),
        n("failed").alias("failed"),
        n("failed", "dead").alias("dlq_routed"),
    )


def skew_report(
    hot: DataFrame,
    cold: DataFrame,
    features: list[str],
    tolerance: float = 0.0,
    keys: list[str] | None = None,
) -> DataFrame:
    """Where the same feature differs between two paths: one row per key and feature.

    A value missing on one side only is a difference. Text must match exactly, numbers within the
    tolerance, and booleans count as 0 and 1.
    """
    keys = keys or ["account_id"]

    def side(df: DataFrame, name: str) -> DataFrame:
        return df.select(*keys, F.struct(*features).alias(name))

    kinds = {f.name: f.dataType for f in hot.schema}
    both = side(hot, "hot").join(side(cold, "cold"), keys)

    def number(column: Column, kind: T.DataType) -> Column:
        if isinstance(kind, T.BooleanType):
            return column.cast("int").cast("double")
        if isinstance(kind, T.NumericType):
            return column.cast("double")
        return F.lit(None).cast("double")

    rows = []
    for f in features:
        h, c = F.col(f"hot.{f}"), F.col(f"cold.{f}")
        gap = F.abs(number(h, kinds[f]) - number(c, kinds[f]))
        rows.append(
            F.struct(
                F.lit(f).alias("feature"),
                h.cast("string").alias("hot_value"),
                c.cast("string").alias("cold_value"),
                gap.alias("gap"),
                F.coalesce(gap > tolerance, ~h.eqNullSafe(c)).alias("differs"),
            )
        )
    return both.select(*keys, F.inline(F.array(*rows))).where("differs").drop("differs")
