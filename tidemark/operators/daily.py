"""Nightly features per account: averages, counts, distinct merchants, percentiles, mode.

Additive values are summed per (account, merchant) first, which also turns the distinct merchant
counts into plain counts. Categories and amounts are counted per value before they meet by account.
No stage holds an account's rows in one task; what meets by account is already one small row per
merchant, category or value cell, combined on the map side.
"""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.clock import day, hour_of_day, is_weekend, wall
from tidemark.functions.numbers import snap
from tidemark.functions.quantiles import grouped_quantiles
from tidemark.operators.staging import lookback
from tidemark.schemas import BATCH, BATCH_DEFAULTS, BATCH_FEATURES, REALTIME, ROLLING

WINDOWS = (7, 30, 90)
PERCENTILES = {
    "txn_amount_p50_90d": 0.50,
    "txn_amount_p95_90d": 0.95,
    "txn_amount_p99_90d": 0.99,
}


def window_totals(
    txns: DataFrame, target_date: date | str, windows: tuple[int, ...] = WINDOWS
) -> DataFrame:
    """Per account and window of w days before the target: rows, amount, online rows, merchants.

    One scan for all windows. Column names end in the window length.
    """
    until = day(target_date)

    def within(w: int, on: str = "transaction_date") -> Column:
        return F.col(on) >= F.date_sub(until, w)

    per_merchant = txns.groupBy("account_id", "merchant_id").agg(
        F.max("transaction_date").alias("last_date"),
        *[F.count(F.when(within(w), 1)).alias(f"n_{w}") for w in windows],
        *[F.sum(F.when(within(w), F.col("amount"))).alias(f"amount_{w}") for w in windows],
        *[F.count(F.when(within(w) & F.col("is_online"), 1)).alias(f"online_{w}") for w in windows],
    )
    named = F.col("merchant_id").isNotNull()
    return per_merchant.groupBy("account_id").agg(
        F.max("last_date").alias("last_date"),
        *[F.sum(f"{part}_{w}").alias(f"{part}_{w}") for part in ("n", "amount", "online") for w in windows],
        *[
            F.count(F.when(within(w, "last_date") & named, 1)).alias(f"merchants_{w}")
            for w in windows
        ],
    )


def common_category(txns: DataFrame) -> DataFrame:
    """Most frequent merchant category per account; the smallest name wins a tie."""
    counts = (
        txns.where(F.col("merchant_category").isNotNull())
        .groupBy("account_id", "merchant_category")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    best = F.min(F.struct((-F.col("n")).alias("rank"), "merchant_category"))
    return counts.groupBy("account_id").agg(
        best["merchant_category"].alias("most_common_merchant_category")
    )


def _finish(rows: DataFrame, target_date: date | str, now: datetime | str | Column) -> DataFrame:
    """Contract columns in order, defaults filled, stamped with the date."""
    kinds = {f.name: f.dataType for f in BATCH}
    return rows.select(
        "account_id",
        day(target_date).alias("computation_date"),
        wall(now).alias("computed_at"),
        *[
            F.coalesce(F.col(n).cast(kinds[n]), F.lit(BATCH_DEFAULTS[n])).alias(n)
            for n in BATCH_FEATURES
        ],
    )


def _idle_days(target_date: date | str, last: Column) -> Column:
    return F.date_diff(day(target_date), last).cast("double")


def daily_features(
    txns: DataFrame,
    target_date: date | str,
    now: datetime | str | Column,
    variant: bool = False,
    totals: DataFrame | None = None,
) -> DataFrame:
    """One row per account with any transaction in the 90 days up to the target date.

    ``txns`` are cleaned transactions. With ``variant`` the online share and the daily average are
    taken over all 90 days instead of 30. ``totals`` hands in window totals that were stored.
    """
    base = lookback(txns, target_date)
    totals = window_totals(base, target_date) if totals is None else totals
    amounts = grouped_quantiles(base, ["account_id"], "amount", PERCENTILES)
    return features_of(totals, amounts, common_category(base), target_date, now, variant)


def features_of(
    totals: DataFrame,
    amounts: DataFrame,
    category: DataFrame,
    target_date: date | str,
    now: datetime | str | Column,
    variant: bool = False,
) -> DataFrame:
    """Contract rows from window totals, percentiles and most common categories per account."""
    span = 90 if variant else 30
    online = F.col(f"online_{span}") / F.col(f"n_{span}").cast("double")
    totals = totals.select(
        "account_id",
        F.when(F.col("n_30") > 0, F.col("amount_30") / F.col("n_30")).alias("avg_txn_amount_30d"),
        F.col("n_30").alias("txn_count_30d"),
        F.col("merchants_30").alias("distinct_merchants_30d"),
        F.col("merchants_7").alias("distinct_merchants_7d"),
        F.col("n_7").alias("txn_count_7d"),
        _idle_days(target_date, F.col("last_date")).alias("days_since_last_txn"),
        (F.col(f"n_{span}") / F.lit(30.0)).alias("avg_daily_txn_count_30d"),
        F.when(F.col(f"n_{span}") > 0, online).alias("pct_online_txns_30d"),
    )
    # Each side has one row per account and is already partitioned by it.
    rows = totals.join(amounts, "account_id", "left").join(category, "account_id", "left")
    return _finish(rows, target_date, now)


def daily_features_v2(
    txns: DataFrame, target_date: date | str, now: datetime | str | Column
) -> DataFrame:
    """The account-only variant: online share and daily average over 90 days, no date column."""
    return daily_features(txns, target_date, now, variant=True).drop("computation_date")


def daily_features_joined(
    txns: DataFrame, target_date: date | str, now: datetime | str | Column
) -> DataFrame:
    """The same rows as daily_features, from four aggregates joined by full outer joins."""
    base = lookback(txns, target_date)
    until = day(target_date)

    def since(w: int) -> DataFrame:
        return base.where(F.col("transaction_date") >= F.date_sub(until, w))

    agg_30d = (
        since(30)
        .groupBy("account_id")
        .agg(
            F.avg("amount").alias("avg_txn_amount_30d"),
            F.count(F.lit(1)).alias("txn_count_30d"),
            F.count_distinct("merchant_id").alias("distinct_merchants_30d"),
            F.avg(F.when(F.col("is_online"), 1.0).otherwise(0.0)).alias("pct_online_txns_30d"),
            (F.count(F.lit(1)) / F.lit(30.0)).alias("avg_daily_txn_count_30d"),
        )
    )
    agg_7d = (
        since(7)
        .groupBy("account_id")
        .agg(
            F.count_distinct("merchant_id").alias("distinct_merchants_7d"),
            F.count(F.lit(1)).alias("txn_count_7d"),
        )
    )
    amounts = grouped_quantiles(base, ["account_id"], "amount", PERCENTILES)
    recency = base.groupBy("account_id").agg(
        _idle_days(target_date, F.max("transaction_date")).alias("days_since_last_txn")
    )
    behaviour = recency.join(common_category(base), "account_id", "left")
    rows = (
        agg_30d.join(agg_7d, "account_id", "full_outer")
        .join(amounts, "account_id", "full_outer")
        .join(behaviour, "account_id", "full_outer")
    )
    return _finish(rows, target_date, now)


def rolling_metrics(
    txns: DataFrame,
    target_date: date | str,
    now: datetime | str | Column,
    windows: tuple[int, ...] = WINDOWS,
    totals: DataFrame | None = None,
) -> DataFrame:
    """Long form: one row per account, window and metric; accounts idle in a window have none."""
    if totals is None:
        totals = window_totals(lookback(txns, target_date, max(windows)), target_date, windows)
    return rolling_of(totals, target_date, now, windows)


def rolling_of(
    totals: DataFrame,
    target_date: date | str,
    now: datetime | str | Column,
    windows: tuple[int, ...] = WINDOWS,
) -> DataFrame:
    """The long form of window totals."""
    branches = F.array(
        *[
            F.struct(
                F.lit(w).alias("window_days"),
                F.lit(metric).alias("metric_name"),
                value.cast("double").alias("metric_value"),
                F.col(f"n_{w}").alias("n"),
            )
            for w in windows
            for metric, value in (
                ("avg_amount", F.try_divide(f"amount_{w}", f"n_{w}")),
                ("txn_count", F.col(f"n_{w}")),
                ("distinct_merchants", F.col(f"merchants_{w}")),
            )
        ]
    )
    return (
        totals.select("account_id", F.inline(branches))
        .where(F.col("n") > 0)
        .select(
            "account_id",
            day(target_date).alias("computation_date"),
            F.col("window_days").cast("int"),
            "metric_name",
            F.coalesce("metric_value", F.lit(0.0)).alias("metric_value"),
            wall(now).alias("computed_at"),
        )
        .select(*ROLLING.names)
    )


def rolling_metrics_union(
    txns: DataFrame,
    target_date: date | str,
    now: datetime | str | Column,
    windows: tuple[int, ...] = WINDOWS,
) -> DataFrame:
    """The same rows as rolling_metrics, as a UNION ALL with one branch per window and metric."""
    base = lookback(txns, target_date, max(windows))
    metrics = {
        "avg_amount": F.avg("amount"),
        "txn_count": F.count(F.lit(1)).cast("double"),
        "distinct_merchants": F.count_distinct("merchant_id").cast("double"),
    }
    union: DataFrame | None = None
    for w in windows:
        recent = base.where(F.col("transaction_date") >= F.date_sub(day(target_date), w))
        for metric, value in metrics.items():
            branch = (
                recent.groupBy("account_id")
                .agg(value.alias("metric_value"))
                .select(
                    "account_id",
                    day(target_date).alias("computation_date"),
                    F.lit(w).cast("int").alias("window_days"),
                    F.lit(metric).alias("metric_name"),
                    F.coalesce("metric_value", F.lit(0.0)).alias("metric_value"),
                    wall(now).alias("computed_at"),
                )
            )
            union = branch if union is None else union.unionByName(branch)
    return union


def latest_features(daily: DataFrame) -> DataFrame:
    """Rows of the newest computation date; on a partitioned table only that partition is read."""
    newest = daily.agg(F.max("computation_date")).scalar()
    return daily.where(F.col("computation_date") == newest)


def bootstrap_realtime(txns: DataFrame, now: datetime | str | Column, last_n: int = 10) -> DataFrame:
    """First realtime rows from history: the last ten events stand in for the last hour."""
    newest_first = Window.partitionBy("account_id").orderBy(
        F.col("event_timestamp").desc(), F.col("event_id").desc()
    )
    # The rank filter is applied before the shuffle too, so at most ten rows per task and account move.
    recent = txns.withColumn("rank", F.row_number().over(newest_first)).where(
        F.col("rank") <= last_n
    )
    newest = F.max_by(
        F.struct("event_timestamp", "is_online", "card_present", "country_code"),
        F.struct("event_timestamp", "event_id"),
    )
    rows = recent.groupBy("account_id").agg(
        F.count(F.lit(1)).alias("n"),
        F.round(F.sum("amount"), 2).alias("txn_amount_sum_1h"),
        F.round(F.max("amount"), 2).alias("txn_amount_max_1h"),
        newest.alias("v"),
    )
    made = {
        "account_id": F.col("account_id"),
        "computed_at": wall(now),
        "txn_count_1h": F.col("n"),
        "txn_amount_sum_1h": F.col("txn_amount_sum_1h"),
        "txn_amount_max_1h": F.col("txn_amount_max_1h"),
        "txn_velocity_5m": F.round(F.col("n") / F.lit(60.0), 4),
        "distance_from_home": F.lit(None),
        "is_new_merchant": F.lit(False),
        "hour_of_day": hour_of_day(F.col("v.event_timestamp")),
        "is_weekend": is_weekend(F.col("v.event_timestamp")),
        "is_online": F.col("v.is_online"),
        "card_present": F.col("v.card_present"),
        "country_code": F.col("v.country_code"),
    }
    return rows.select(*[made[f.name].cast(f.dataType).alias(f.name) for f in REALTIME])


def bootstrap_batch(txns: DataFrame, now: datetime | str | Column) -> DataFrame:
    """First batch rows from the full history, whatever its length, with nearest-rank percentiles."""
    per_merchant = txns.groupBy("account_id", "merchant_id").agg(
        F.count(F.lit(1)).alias("n"),
        F.sum("amount").alias("amount"),
        F.count(F.when(F.col("is_online"), 1)).alias("online"),
    )
    n = F.col("n")
    totals = (
        per_merchant.groupBy("account_id")
        .agg(
            F.sum("n").alias("n"),
            F.sum("amount").alias("amount"),
            F.sum("online").alias("online"),
            F.count("merchant_id").alias("merchants"),
        )
        .select(
            "account_id",
            snap(F.col("amount") / n, 2).alias("avg_txn_amount_30d"),
            n.alias("txn_count_30d"),
            F.col("merchants").alias("distinct_merchants_30d"),
            F.col("merchants").alias("distinct_merchants_7d"),
            n.alias("txn_count_7d"),
            F.lit(0.0).alias("days_since_last_txn"),
            F.round(n / F.lit(30.0), 2).alias("avg_daily_txn_count_30d"),
            snap(F.col("online") / n.cast("double"), 2).alias("pct_online_txns_30d"),
        )
    )
    amounts = grouped_quantiles(txns, ["account_id"], "amount", PERCENTILES, method="nearest")
    rows = totals.join(amounts, "account_id", "left").join(
        common_category(txns), "account_id", "left"
    )
    rounded = rows.withColumns({name: F.round(name, 2) for name in PERCENTILES})
    kinds = {f.name: f.dataType for f in BATCH}
    return rounded.select(
        "account_id",
        wall(now).alias("computed_at"),
        *[F.col(c).cast(kinds[c]).alias(c) for c in BATCH_FEATURES],
    )


def txn_summary(txns: DataFrame, high_value: float = 500.0) -> DataFrame:
    """One row: how many transactions and accounts, the amount range, and the high-value share.

    Accounts are reduced to one row each before they are counted.
    """
    per_account = txns.groupBy("account_id").agg(
        F.count(F.lit(1)).alias("n"),
        F.min("amount").alias("low"),
        F.max("amount").alias("high"),
        F.sum("amount").alias("amount"),
        F.count(F.when(F.col("amount") > high_value, 1)).alias("high_value"),
    )
    n = F.sum("n")
    return per_account.agg(
        n.alias("num_transactions"),
        F.count("account_id").alias("unique_accounts"),
        F.min("low").alias("min_amount"),
        F.max("high").alias("max_amount"),
        (F.sum("amount") / n).alias("avg_amount"),
        F.sum("high_value").alias("high_value_transactions"),
        (F.sum("high_value") / n.cast("double")).alias("high_value_share"),
    )
