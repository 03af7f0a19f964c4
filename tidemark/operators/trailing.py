"""Per-event trailing features: the last hour, the last five minutes, distance, novelty.

A sliding range frame re-reads its whole frame for every row, so a busy account costs quadratic
time in one task. Here time is cut into slices as long as the frame. The frame that ends at an event
is then the tail of the previous slice plus the head of its own, and both are running aggregates
that only ever grow. Each event is sent to its own slice and, as context, to the next one; groups are
(account, slice), so an account with a third of all rows spreads over as many tasks as it has hours.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.clock import MICROS, hour_of_day, is_weekend, micros
from tidemark.functions.geo import haversine_km
from tidemark.functions.numbers import velocity
from tidemark.schemas import REALTIME

HOUR = 3600 * MICROS
FIVE_MINUTES = 300 * MICROS

_OWN, _HOUR_CONTEXT, _FIVE_CONTEXT = 0, 1, 2


def trailing_counts(txns: DataFrame, keep: list[str]) -> DataFrame:
    """Count, sum and max over [t - 1 h, t] and count over [t - 5 min, t], per event.

    Both ends belong to the frame, as do the event itself and others at the same instant. One
    shuffle, on (account, hour); the five-minute groups lie inside it.
    """
    us = micros(F.col("event_timestamp"))
    five = F.floor(us / FIVE_MINUTES)
    own_hour = F.floor(us / HOUR)
    copies = F.explode(
        F.array(
            F.struct(F.lit(_OWN).alias("role"), own_hour.alias("hour"), five.alias("five")),
            F.struct(
                F.lit(_HOUR_CONTEXT).alias("role"),
                (own_hour + 1).alias("hour"),
                F.lit(None).cast("bigint").alias("five"),
            ),
            F.struct(
                F.lit(_FIVE_CONTEXT).alias("role"),
                F.floor((five + 1) * FIVE_MINUTES / HOUR).alias("hour"),
                (five + 1).alias("five"),
            ),
        )
    )
    payload = [c for c in keep if c not in ("account_id", "amount")]
    rows = txns.select("account_id", "amount", us.alias("us"), copies.alias("c"), *payload)
    own = F.col("role") == _OWN
    rows = rows.select(
        "account_id",
        "amount",
        "us",
        "c.role",
        "c.hour",
        "c.five",
        # Context rows only carry what the aggregates read.
        *[F.when(F.col("c.role") == _OWN, F.col(p)).alias(p) for p in payload],
    )
    hour_context = F.col("role") == _HOUR_CONTEXT
    five_context = F.col("role") == _FIVE_CONTEXT

    def running(*keys: str, order: list[Column]):
        return (
            Window.partitionBy("account_id", *keys)
            .orderBy(*order)
            .rangeBetween(Window.unboundedPreceding, Window.currentRow)
        )

    def looking_back(micros_: int) -> list[Column]:
        # Descending: an event looks back one frame and sees the context at or after that point.
        return [F.when(own, F.col("us") - micros_).otherwise(F.col("us")).desc()]

    # Own rows come in time order either way; with "five" first both heads share one sort.
    head = running("hour", order=[F.col("five"), F.col("us")])
    head5 = running("hour", "five", order=[F.col("us")])
    tail = running("hour", order=looking_back(HOUR))
    tail5 = running("hour", "five", order=looking_back(FIVE_MINUTES))

    def n(rows_: Column, over) -> Column:
        return F.count(F.when(rows_, 1)).over(over)

    def amount(rows_: Column) -> Column:
        return F.when(rows_, F.col("amount"))

    def total(rows_: Column, over) -> Column:
        return F.coalesce(F.sum(amount(rows_)).over(over), F.lit(0.0))

    parts = rows.withColumns(
        {
            "n_tail": n(hour_context, tail),
            "sum_tail": total(hour_context, tail),
            "max_tail": F.max(amount(hour_context)).over(tail),
        }
    ).withColumns(
        {
            "n_head": n(own, head),
            "sum_head": total(own, head),
            "max_head": F.max(amount(own)).over(head),
        }
    )
    parts = parts.withColumn("n5_head", n(own, head5))
    parts = parts.withColumn("n5_tail", n(five_context, tail5))
    largest = F.coalesce(F.greatest("max_head", "max_tail"), F.lit(0.0))
    return parts.where(own).select(
        *keep,
        (F.col("n_head") + F.col("n_tail")).alias("txn_count_1h"),
        F.round(F.col("sum_head") + F.col("sum_tail"), 2).alias("txn_amount_sum_1h"),
        F.round(largest, 2).alias("txn_amount_max_1h"),
        (F.col("n5_head") + F.col("n5_tail")).alias("txn_count_5m"),
    )


def first_visits(txns: DataFrame) -> DataFrame:
    """The first event of each account at each merchant; pre-aggregated before the shuffle."""
    first = F.min(F.struct("event_timestamp", "event_id")).alias("first")
    return (
        txns.groupBy("account_id", "merchant_id")
        .agg(first)
        .select(
            "account_id",
            "merchant_id",
            F.col("first.event_timestamp").alias("first_seen"),
            F.col("first.event_id").alias("event_id"),
        )
    )


def is_new_merchant(txns: DataFrame, history: DataFrame | None = None) -> DataFrame:
    """Add ``is_new_merchant``: no earlier event of this account at this merchant.

    ``history`` (account_id, merchant_id) lists pairs known before these rows. Events join the first
    visits on the whole event (pair, id and time, NULLs alike), so no busy pair gathers in one task.
    Repeats of an event are one event: all of them are new, or none. Drop repeats before.
    """
    firsts = first_visits(txns)
    if history is not None:
        known = history.select("account_id", "merchant_id").distinct()
        firsts = firsts.join(known, ["account_id", "merchant_id"], "left_anti")
    return _flagged(txns, firsts)


def _flagged(events: DataFrame, firsts: DataFrame) -> DataFrame:
    """Events with ``is_new_merchant``; firsts: the first visits that count as new."""
    pairs = [
        ("account_id", "account_id"),
        ("merchant_id", "merchant_id"),
        ("event_timestamp", "first_seen"),
        ("event_id", "event_id"),
    ]
    flags = firsts.select(
        *[F.col(name).alias(f"_{own}") for own, name in pairs], F.lit(True).alias("_new")
    )
    same = [F.col(own).eqNullSafe(F.col(f"_{own}")) for own, _ in pairs]
    return (
        events.join(flags, reduce(lambda a, b: a & b, same), "left")
        .withColumn("is_new_merchant", F.coalesce("_new", F.lit(False)))
        .drop("_new", *[f"_{own}" for own, _ in pairs])
    )


def profile_versions(profiles: DataFrame) -> DataFrame:
    """Profiles with ``updated_at`` as versions: each holds from its update up to the account's next.

    Of updates at one moment the one with the larger position stays. The first version holds from its
    own update, so earlier events have no home; a NULL update holds from the beginning.
    """
    columns = [c for c in profiles.columns if c not in ("account_id", "updated_at")]
    last = F.max_by(F.struct(*columns), F.struct("home_latitude", "home_longitude"))
    one = profiles.groupBy("account_id", "updated_at").agg(F.coalesce(last, F.first(F.struct(*columns))).alias("v"))
    # An account's versions at a time, never its events.
    following = Window.partitionBy("account_id").orderBy(F.col("updated_at").asc_nulls_first())
    return one.select(
        "account_id",
        "v.*",
        F.col("updated_at").alias("valid_from"),
        F.lead("updated_at").over(following).alias("valid_to"),
    )


def distance_from_home(txns: DataFrame, profiles: DataFrame) -> DataFrame:
    """Add ``distance_from_home`` in km, NULL when either position is unknown.

    Versions (``profile_versions``) are joined by the interval in which they hold, so the home is the
    one at the event's time; works on streams, with the versions as a table. No broadcast hint: profiles
    grow with the accounts, so the planner decides by their size and AQE splits the partition of a busy
    account.
    """
    versioned = "valid_from" in profiles.columns
    homes = profiles.select(
        F.col("account_id").alias("_owner"),
        "home_latitude",
        "home_longitude",
        *(["valid_from", "valid_to"] if versioned else []),
    )
    own = F.col("account_id") == F.col("_owner")
    if versioned:
        at = F.col("event_timestamp").cast("timestamp_ntz")
        begun = F.col("valid_from").isNull() | (F.col("valid_from") <= at)
        own = own & begun & (F.col("valid_to").isNull() | (at < F.col("valid_to")))
    km = haversine_km(
        F.col("latitude"), F.col("longitude"), F.col("home_latitude"), F.col("home_longitude")
    )
    return (
        txns.join(homes, own, "left")
        .withColumn("distance_from_home", F.round(km, 2))
        .drop("_owner", "home_latitude", "home_longitude", "valid_from", "valid_to")
    )


def trailing_features(
    txns: DataFrame,
    profiles: DataFrame | None = None,
    history: DataFrame | None = None,
    mode: str = "shared",
    counts: Callable[[DataFrame, list[str]], DataFrame] = trailing_counts,
) -> DataFrame:
    """The complete realtime feature row as of every event, computed_at being the event time.

    ``counts`` is trailing_counts, with one shuffle, or pane_frames.counts_by_pane, which also splits
    an account that fills an hour; both give the same rows.
    """
    located = (
        txns.withColumn("distance_from_home", F.lit(None).cast("double"))
        if profiles is None
        else distance_from_home(txns, profiles)
    )
    keep = [
        "event_id",
        "account_id",
        "merchant_id",
        "event_timestamp",
        "distance_from_home",
        "is_online",
        "card_present",
        "country_code",
    ]
    counted = counts(located, keep)
    firsts = first_visits(txns)
    if history is not None:
        known = history.select("account_id", "merchant_id").distinct()
        firsts = firsts.join(known, ["account_id", "merchant_id"], "left_anti")
    full = _flagged(counted, firsts).withColumns(
        {
            "computed_at": F.col("event_timestamp"),
            "txn_velocity_5m": velocity(F.col("txn_count_5m"), F.col("txn_count_1h"), mode),
            "hour_of_day": hour_of_day(F.col("event_timestamp")),
            "is_weekend": is_weekend(F.col("event_timestamp")),
        }
    )
    return full.select("event_id", *REALTIME.names)


def last_values(txns: DataFrame) -> DataFrame:
    """Newest merchant, position and channel flags per account, ties broken by event_id."""
    newest = F.max_by(
        F.struct(
            "merchant_id",
            "latitude",
            "longitude",
            "is_online",
            "card_present",
            "country_code",
            "event_timestamp",
        ),
        F.struct("event_timestamp", "event_id"),
    )
    return (
        txns.groupBy("account_id")
        .agg(newest.alias("v"))
        .select(
            "account_id",
            F.col("v.merchant_id").alias("last_merchant_id"),
            F.col("v.latitude").alias("last_latitude"),
            F.col("v.longitude").alias("last_longitude"),
            F.col("v.is_online").alias("last_is_online"),
            F.col("v.card_present").alias("last_card_present"),
            F.col("v.country_code").alias("last_country_code"),
            F.col("v.event_timestamp").alias("last_event_time"),
        )
    )
