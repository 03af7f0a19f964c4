"""Opt-in estimates from mergeable sketches: one per account and day, unioned over a window.

A day's sketch is made once, when the day is closed, and is a few kilobytes however busy the account
was. Windows of 7, 30 or 90 days are unions of stored sketches, so no event is read again. Counts, sums
and shares stay exact; only distinct merchants (HyperLogLog) and percentiles (KLL) are estimates, with
the errors that ``distinct_error`` and ``rank_error`` state.
"""

from __future__ import annotations

import math
from datetime import date, datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.clock import day
from tidemark.operators import daily

DISTINCT_LG_K = 12
QUANTILE_K = 400
PERCENTILES = (0.5, 0.95, 0.99)


def distinct_error(lg_k: int = DISTINCT_LG_K) -> float:
    """Relative error of a distinct count, at three standard deviations of a union."""
    return 3 * 1.04 / math.sqrt(1 << lg_k)


def rank_error(k: int = QUANTILE_K) -> float:
    """How far the rank of a returned quantile may be from the one asked for, as a share of rows."""
    return 2.296 / k**0.9021


def day_sketches(
    txns: DataFrame,
    first: date | str,
    last: date | str | None = None,
    lg_k: int = DISTINCT_LG_K,
    k: int = QUANTILE_K,
) -> DataFrame:
    """Per account and day of cleaned transactions: rows, amount, online rows and two sketches.

    Sketches are built on the map side, so a busy account sends one per task.
    """
    inside = F.col("transaction_date").between(day(first), day(last or first))
    return (
        txns.where(inside)
        .groupBy("account_id", "transaction_date")
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.sum("amount").alias("amount"),
            F.count(F.when(F.col("is_online"), 1)).alias("online"),
            F.hll_sketch_agg("merchant_id", lg_k).alias("merchants"),
            F.kll_sketch_agg_double("amount", k).alias("amounts"),
        )
    )


def window_sketches(
    sketches: DataFrame,
    target_date: date | str,
    windows: tuple[int, ...] = daily.WINDOWS,
    k: int = QUANTILE_K,
) -> DataFrame:
    """Per account: last day, and for each window its rows, amount, online rows and united sketches."""
    until = day(target_date)
    on = F.col("transaction_date")
    rows = sketches.where(on.between(F.date_sub(until, max(windows)), until))

    def within(w: int, value: Column) -> Column:
        return F.when(on >= F.date_sub(until, w), value)

    return rows.groupBy("account_id").agg(
        F.max(on).alias("last_date"),
        *[
            F.coalesce(F.sum(within(w, F.col(part))), F.lit(0)).alias(f"{part}_{w}")
            for part in ("n", "amount", "online")
            for w in windows
        ],
        *[F.hll_union_agg(within(w, F.col("merchants"))).alias(f"merchants_{w}") for w in windows],
        *[
            F.kll_merge_agg_double(within(w, F.col("amounts")), k).alias(f"amounts_{w}")
            for w in windows
        ],
    )


def _quantile(w: int, p: float) -> Column:
    value = F.kll_sketch_get_quantile_double(f"amounts_{w}", F.lit(p))
    return F.when(F.col(f"n_{w}") > 0, value)


def _merchants(w: int) -> Column:
    estimate = F.hll_sketch_estimate(f"merchants_{w}")
    return F.when(F.col(f"n_{w}") > 0, estimate).otherwise(F.lit(0).cast("bigint"))


def estimates(
    united: DataFrame,
    windows: tuple[int, ...] = daily.WINDOWS,
    percentiles: tuple[float, ...] = PERCENTILES,
) -> DataFrame:
    """Long form of what ``window_sketches`` returns: one row per account and window with rows."""
    branches = F.array(
        *[
            F.struct(
                F.lit(w).alias("window_days"),
                F.col(f"n_{w}").alias("n"),
                _merchants(w).alias("distinct_merchants"),
                *[_quantile(w, p).alias(f"p{round(100 * p)}") for p in percentiles],
            )
            for w in windows
        ]
    )
    return united.select("account_id", F.inline(branches)).where(F.col("n") > 0)


def day_categories(txns: DataFrame, first: date | str, last: date | str | None = None) -> DataFrame:
    """Rows per account, day and category; what the most common category is read from."""
    inside = F.col("transaction_date").between(day(first), day(last or first))
    named = txns.where(inside & F.col("merchant_category").isNotNull())
    return named.groupBy("account_id", "transaction_date", "merchant_category").agg(
        F.count(F.lit(1)).alias("n")
    )


def estimated_features(
    sketches: DataFrame,
    categories: DataFrame,
    target_date: date | str,
    now: datetime | str | Column,
) -> DataFrame:
    """The rows of ``daily.daily_features`` with estimates, from stored sketches and category counts."""
    until = day(target_date)
    united = window_sketches(sketches, target_date)
    totals = united.select(
        "account_id",
        "last_date",
        *[f"{part}_{w}" for part in ("n", "amount", "online") for w in daily.WINDOWS],
        *[_merchants(w).alias(f"merchants_{w}") for w in daily.WINDOWS],
    )
    amounts = united.select(
        "account_id", *[_quantile(90, p).alias(name) for name, p in daily.PERCENTILES.items()]
    )
    inside = F.col("transaction_date").between(F.date_sub(until, 90), until)
    counts = categories.where(inside).groupBy("account_id", "merchant_category")
    best = F.min(F.struct((-F.col("n")).alias("rank"), "merchant_category"))
    category = (
        counts.agg(F.sum("n").alias("n"))
        .groupBy("account_id")
        .agg(best["merchant_category"].alias("most_common_merchant_category"))
    )
    return daily.features_of(totals, amounts, category, target_date, now)


def accuracy(
    estimated: DataFrame,
    txns: DataFrame,
    target_date: date | str,
    windows: tuple[int, ...] = daily.WINDOWS,
    lg_k: int = DISTINCT_LG_K,
    k: int = QUANTILE_K,
    percentiles: tuple[float, ...] = PERCENTILES,
) -> DataFrame:
    """Whether each estimate lies within its stated error of the exact value, per account and window.

    A quantile is right if its rank among the exact amounts is. Reads the events, to judge by them.
    """
    until = day(target_date)
    exact = daily.window_totals(
        txns.where(F.col("transaction_date").between(F.date_sub(until, max(windows)), until)),
        target_date,
        windows,
    )
    counts = exact.select(
        "account_id",
        F.inline(
            F.array(
                *[
                    F.struct(
                        F.lit(w).alias("window_days"),
                        F.col(f"n_{w}").alias("rows"),
                        F.col(f"merchants_{w}").alias("exact_merchants"),
                    )
                    for w in windows
                ]
            )
        ),
    )
    names = [f"p{round(100 * p)}" for p in percentiles]
    ages = F.filter(
        F.array(*[F.lit(w) for w in windows]),
        lambda w: F.col("transaction_date") >= F.date_sub(until, w),
    )
    rows = txns.where(F.col("transaction_date") <= until).select(
        "account_id", "amount", F.explode(ages).alias("window_days")
    )
    amounts = rows.groupBy("account_id", "window_days", "amount").agg(F.count(F.lit(1)).alias("c"))
    asked = estimated.select("account_id", "window_days", *names)
    ranks = (
        amounts.join(asked, ["account_id", "window_days"])
        .groupBy("account_id", "window_days")
        .agg(
            *[F.sum(F.when(F.col("amount") < F.col(n), F.col("c")).otherwise(0)).alias(f"{n}_below") for n in names],
            *[F.sum(F.when(F.col("amount") <= F.col(n), F.col("c")).otherwise(0)).alias(f"{n}_upto") for n in names],
        )
    )
    joined = estimated.join(counts, ["account_id", "window_days"]).join(
        ranks, ["account_id", "window_days"]
    )
    off = F.abs(F.col("distinct_merchants") - F.col("exact_merchants"))
    error = rank_error(k)
    return joined.select(
        "account_id",
        "window_days",
        "rows",
        "exact_merchants",
        (off <= F.lit(distinct_error(lg_k)) * F.col("exact_merchants")).alias("merchants_within"),
        *[
            (
                (F.col(f"{n}_below") / F.col("rows") <= F.lit(p + error))
                & (F.col(f"{n}_upto") / F.col("rows") >= F.lit(p - error))
            ).alias(f"{n}_within")
            for n, p in zip(names, percentiles)
        ],
    )
