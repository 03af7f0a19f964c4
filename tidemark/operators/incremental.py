"""Nightly features by delta: every date adds one day and retires one.

What a date needs of the 90 days before it is kept as a state of four tables, all keyed by account and
none with an account's rows in one group:

* ``days``: per account an array with one entry per active day (rows, amount, online rows), at most 91.
  Totals of a window are added up from it in the order of days, so nothing drifts over the dates.
* ``merchants``: per (account, merchant) the last day it was seen; a window's distinct merchants are
  those seen since its start.
* ``categories`` and ``amounts``: per (account, category) and (account, amount) the rows in the window,
  whole numbers to which a day is added and from which the retired day is taken away. The mode and
  the exact percentiles follow from them.

A day's own partials are stored when the day is added, and the day that leaves the window is taken
away from what was stored, so a correction of the source in between can't leave a remainder behind.
A corrected date is run again on the state of the day before, and so are the dates after it. Results
equal ``daily_features`` and ``rolling_metrics`` of the whole look-back.
"""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date, datetime, timedelta
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.clock import day
from tidemark.functions.quantiles import grouped_quantiles
from tidemark.operators import daily

KEPT_DAYS = 90
TABLES = ("days", "merchants", "categories", "amounts")


@dataclass
class Tables:
    """The four tables: partials per ``transaction_date``, or the state after a date."""

    days: DataFrame
    merchants: DataFrame
    categories: DataFrame
    amounts: DataFrame

    def named(self) -> dict[str, DataFrame]:
        return {name: getattr(self, name) for name in TABLES}


def partials(txns: DataFrame, first: date | str, last: date | str | None = None) -> Tables:
    """Each day's own rows, from one day of cleaned transactions or from a range, ends included.

    Only these days are read. Merchants are reduced first: an account's totals come from its
    merchants' rows.
    """
    rows = txns.where(F.col("transaction_date").between(day(first), day(last or first)))
    key = ["account_id", "transaction_date"]
    n = F.count(F.lit(1)).alias("n")
    per_merchant = rows.groupBy(*key, "merchant_id").agg(
        n,
        F.sum("amount").alias("amount"),
        F.count(F.when(F.col("is_online"), 1)).alias("online"),
    )
    sums = [F.sum(c).alias(c) for c in ("n", "amount", "online")]
    categorised = rows.where(F.col("merchant_category").isNotNull())
    return Tables(
        days=per_merchant.groupBy(*key).agg(*sums),
        merchants=per_merchant.where(F.col("merchant_id").isNotNull()).select(*key, "merchant_id"),
        categories=categorised.groupBy(*key, "merchant_category").agg(n),
        amounts=rows.groupBy(*key, "amount").agg(n),
    )


def first_state(parts: Tables, upto: date | str) -> Tables:
    """The state after a date from the partials of the whole window, to start with."""
    inside = F.col("transaction_date").between(F.date_sub(day(upto), KEPT_DAYS), day(upto))
    window = {name: table.where(inside) for name, table in parts.named().items()}
    entry = F.struct(F.col("transaction_date").alias("day"), "n", "amount", "online")
    total = F.sum("n").alias("n")
    return Tables(
        days=window["days"].groupBy("account_id").agg(
            F.array_sort(F.collect_list(entry)).alias("days")
        ),
        merchants=window["merchants"].groupBy("account_id", "merchant_id").agg(
            F.max("transaction_date").alias("last_date")
        ),
        categories=window["categories"].groupBy("account_id", "merchant_category").agg(total),
        amounts=window["amounts"].groupBy("account_id", "amount").agg(total),
    )


def retired_day(added: date | str) -> date:
    """The day that leaves the window when ``added`` enters it."""
    return date.fromisoformat(str(added)) - timedelta(days=KEPT_DAYS + 1)


def advance(state: Tables, came: Tables, gone: Tables | None, added: date | str) -> Tables:
    """The state after ``added``, from the state after the day before.

    ``came`` are the partials of ``added``; ``gone`` those of ``retired_day(added)``, as they were
    when that day was added, or None if it had none.
    """
    oldest = F.date_sub(day(added), KEPT_DAYS)

    entry = F.struct(F.col("transaction_date").alias("day"), "n", "amount", "online")
    fresh = came.days.select("account_id", F.array(entry).alias("came"))
    none = F.array().cast(dict(state.days.dtypes)["days"])
    both = F.concat(F.coalesce("days", none), F.coalesce("came", none))
    days = (
        state.days.join(fresh, "account_id", "full_outer")
        .select("account_id", F.filter(both, lambda d: d["day"] >= oldest).alias("days"))
        .where(F.size("days") > 0)
    )

    seen = came.merchants.withColumnRenamed("transaction_date", "last_date")
    merchants = (
        state.merchants.where(F.col("last_date") >= oldest)
        .unionByName(seen)
        .groupBy("account_id", "merchant_id")
        .agg(F.max("last_date").alias("last_date"))
    )

    def counted(name: str) -> DataFrame:
        table = getattr(state, name)
        keys = [c for c in table.columns if c != "n"]
        parts = [table, getattr(came, name).select(*keys, "n")]
        if gone is not None:
            parts.append(getattr(gone, name).select(*keys, (-F.col("n")).alias("n")))
        total = reduce(DataFrame.unionByName, parts).groupBy(*keys).agg(F.sum("n").alias("n"))
        return total.where(F.col("n") != 0)

    return Tables(days, merchants, counted("categories"), counted("amounts"))


def window_totals(
    state: Tables, upto: date | str, windows: tuple[int, ...] = daily.WINDOWS
) -> DataFrame:
    """The columns of ``daily.window_totals``, from the state after ``upto``."""
    if max(windows) > KEPT_DAYS:
        raise ValueError(f"the state holds {KEPT_DAYS} days")

    def since(w: int) -> Column:
        return F.date_sub(day(upto), w)

    def total(w: int, part: str) -> Column:
        inside = F.filter("days", lambda d: d["day"] >= since(w))
        zero = F.lit(0.0) if part == "amount" else F.lit(0).cast("bigint")
        return F.aggregate(inside, zero, lambda a, d: a + d[part]).alias(f"{part}_{w}")

    totals = state.days.select(
        "account_id",
        F.array_max(F.transform("days", lambda d: d["day"])).alias("last_date"),
        *[total(w, part) for part in ("n", "amount", "online") for w in windows],
    )
    merchants = state.merchants.groupBy("account_id").agg(
        *[
            F.count(F.when(F.col("last_date") >= since(w), 1)).alias(f"merchants_{w}")
            for w in windows
        ]
    )
    joined = totals.join(merchants, "account_id", "left")
    return joined.fillna(0, [f"merchants_{w}" for w in windows])


def daily_features(
    state: Tables,
    target_date: date | str,
    now: datetime | str | Column,
    totals: DataFrame | None = None,
) -> DataFrame:
    """The rows of ``daily.daily_features``, from the state after the target date."""
    best = F.min(F.struct((-F.col("n")).alias("rank"), "merchant_category"))
    category = state.categories.groupBy("account_id").agg(
        best["merchant_category"].alias("most_common_merchant_category")
    )
    amounts = grouped_quantiles(
        state.amounts, ["account_id"], "amount", daily.PERCENTILES, weight="n"
    )
    totals = window_totals(state, target_date) if totals is None else totals
    return daily.features_of(totals, amounts, category, target_date, now)


def rolling_metrics(
    state: Tables,
    target_date: date | str,
    now: datetime | str | Column,
    totals: DataFrame | None = None,
) -> DataFrame:
    """The rows of ``daily.rolling_metrics``, from the state after the target date."""
    totals = window_totals(state, target_date) if totals is None else totals
    return daily.rolling_of(totals, target_date, now)
