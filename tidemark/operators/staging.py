"""Lenient path: the cleaned transaction view the nightly features read."""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.clock import day, wall


def clean(txns: DataFrame, now: datetime | str | Column) -> DataFrame:
    """Drop negative, unowned, undated and future-dated rows; normalise case; fill defaults."""
    kept = txns.where(
        (F.col("amount") >= 0)
        & F.col("account_id").isNotNull()
        & F.col("event_timestamp").isNotNull()
        & (F.col("event_timestamp") <= wall(now))
    )
    return kept.withColumns(
        {
            "merchant_category": F.coalesce(F.lower("merchant_category"), F.lit("unknown")),
            "transaction_type": F.lower("transaction_type"),
            "is_online": F.coalesce("is_online", F.lit(False)),
            "card_present": F.coalesce("card_present", F.lit(True)),
            "country_code": F.coalesce("country_code", F.lit("US")),
        }
    )


def lookback(txns: DataFrame, target_date: date | str, days: int = 90) -> DataFrame:
    """Rows dated from ``days`` before the target up to it, both ends included.

    On a table partitioned by transaction_date this prunes partitions.
    """
    until = day(target_date)
    return txns.where(F.col("transaction_date").between(F.date_sub(until, days), until))


def dedupe(txns: DataFrame) -> DataFrame:
    """One row per event_id, for sources that deliver at least once."""
    return txns.dropDuplicates(["event_id"])


def in_time_order(txns: DataFrame) -> DataFrame:
    """Events sorted by time over the whole frame, for a replay; ties follow event_id."""
    return txns.orderBy("event_timestamp", "event_id")
