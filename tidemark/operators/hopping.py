"""One-hour window sliding by ten seconds, built from ten-second panes.

Spelling the sliding window out puts every event into 360 windows. Panes hold each event once;
a window that ends with a pane is the sum of the 360 panes up to it. Only the window that first
contains an account's newest event is emitted, so one row per (account, pane) comes out.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.clock import MICROS, from_micros, hour_of_day, is_weekend, micros, wall
from tidemark.functions.numbers import velocity
from tidemark.schemas import REALTIME, REALTIME_DEFAULTS

SLIDE_SECONDS = 10
HOUR_SECONDS = 3600
DAY_SECONDS = 86_400
FIVE_MINUTES_SECONDS = 300

LAST_COLUMNS = [
    "merchant_id",
    "latitude",
    "longitude",
    "is_online",
    "card_present",
    "country_code",
]


def pane_aggregates(carried: tuple[str, ...] = ()) -> list[Column]:
    """Mergeable pane contents; the newest row's values are picked by (time, event_id).

    ``carried`` are further columns of which the newest row's values are kept.
    """
    newest = F.struct("event_timestamp", "event_id")
    return [
        F.count(F.lit(1)).alias("n"),
        F.sum("amount").alias("amount_sum"),
        F.max("amount").alias("amount_max"),
        F.max_by(F.struct(*LAST_COLUMNS, "event_timestamp", "event_id", *carried), newest).alias(
            "newest"
        ),
    ]


def panes(txns: DataFrame, slide: int = SLIDE_SECONDS) -> DataFrame:
    """Tumbling panes per account, keyed by the exclusive end of the pane in epoch seconds."""
    end = (F.floor(micros(F.col("event_timestamp")) / (slide * MICROS)) + 1) * slide
    return txns.groupBy("account_id", end.alias("pane_end")).agg(*pane_aggregates())


def windows_over(
    panes_: DataFrame, slide: int = SLIDE_SECONDS, carried: tuple[str, ...] = ()
) -> DataFrame:
    """Window totals at every pane end.

    A frame holds at most 360 panes, however many events they stand for. Groups are (account, day):
    8640 panes and the last hour of the day before, which is sent along as context. So a busy
    account is bounded by time, not by volume, and its days run in parallel.
    """
    own_day = F.floor(F.col("pane_end") / DAY_SECONDS)
    last_day = F.floor((F.col("pane_end") + HOUR_SECONDS - slide) / DAY_SECONDS)
    days = panes_.withColumn("day", F.explode(F.sequence(own_day, last_day)))
    by_day = Window.partitionBy("account_id", "day").orderBy("pane_end")
    hour = by_day.rangeBetween(slide - HOUR_SECONDS, 0)
    five = by_day.rangeBetween(slide - FIVE_MINUTES_SECONDS, 0)
    totals = days.select(
        "account_id",
        "day",
        "pane_end",
        F.sum("n").over(hour).alias("txn_count_1h"),
        F.round(F.sum("amount_sum").over(hour), 2).alias("txn_amount_sum_1h"),
        F.round(F.max("amount_max").over(hour), 2).alias("txn_amount_max_1h"),
        F.sum("n").over(five).alias("txn_count_5m"),
        *[F.col(f"newest.{c}").alias(f"last_{c}") for c in LAST_COLUMNS],
        F.col("newest.event_timestamp").cast("timestamp_ntz").alias("last_event_time"),
        from_micros(F.col("pane_end") * MICROS).alias("window_end"),
        *[F.col(f"newest.{c}").alias(c) for c in carried],
    )
    return totals.where(F.col("day") == own_day).drop("day")


def hop_features(txns: DataFrame, slide: int = SLIDE_SECONDS) -> DataFrame:
    return windows_over(panes(txns, slide), slide).drop("pane_end")


def realtime_rows(
    hops: DataFrame,
    computed_at: datetime | str | Column,
    mode: str = "shared",
    extra: tuple[str, ...] = (),
) -> DataFrame:
    """Window totals as realtime feature rows, with defaults for whatever is missing.

    ``distance_from_home`` and ``is_new_merchant`` are taken when the caller has looked them up;
    ``extra`` columns pass through.
    """
    looked_up = set(hops.columns)

    def filled(name: str, value: Column) -> Column:
        return F.coalesce(value, F.lit(REALTIME_DEFAULTS[name])).alias(name)

    last = F.col("last_event_time")
    made = {
        "account_id": F.col("account_id"),
        "computed_at": wall(computed_at),
        "txn_count_1h": filled("txn_count_1h", F.col("txn_count_1h")),
        "txn_amount_sum_1h": filled("txn_amount_sum_1h", F.col("txn_amount_sum_1h")),
        "txn_amount_max_1h": filled("txn_amount_max_1h", F.col("txn_amount_max_1h")),
        "txn_velocity_5m": filled(
            "txn_velocity_5m", velocity(F.col("txn_count_5m"), F.col("txn_count_1h"), mode)
        ),
        "distance_from_home": (
            F.col("distance_from_home") if "distance_from_home" in looked_up else F.lit(None)
        ),
        "is_new_merchant": (
            filled("is_new_merchant", F.col("is_new_merchant"))
            if "is_new_merchant" in looked_up
            else F.lit(False)
        ),
        "hour_of_day": filled("hour_of_day", hour_of_day(last)),
        "is_weekend": filled("is_weekend", is_weekend(last)),
        "is_online": filled("is_online", F.col("last_is_online")),
        "card_present": filled("card_present", F.col("last_card_present")),
        "country_code": filled("country_code", F.col("last_country_code")),
    }
    return hops.select(*[made[f.name].cast(f.dataType).alias(f.name) for f in REALTIME], *extra)
