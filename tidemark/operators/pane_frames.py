"""Trailing frames for accounts that may fill an hour, or any stretch of time, on their own.

As in ``trailing.trailing_counts`` the frame that ends at an event is cut at fixed times, here into
panes of a few seconds: the head of its own pane, the tail of the pane one frame earlier, and whole
panes between them. Head and tail are running aggregates that only ever grow; whole panes come from
pane totals, combined on the map side. Groups of events are (account, pane), so an account with a
third of all rows spreads over many tasks even if they fall into one hour. That costs two further
shuffles, of one row per account and pane.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.clock import MICROS, micros
from tidemark.operators.trailing import FIVE_MINUTES, HOUR

DAY = 86_400 * MICROS
PANE = 10 * MICROS

_OWN, _HOUR_CONTEXT, _FIVE_CONTEXT, _BETWEEN = 0, 1, 2, 3


def _whole_panes(txns: DataFrame, pane_micros: int) -> DataFrame:
    """account_id, pane and the totals of the whole panes inside the frames that end in it.

    Frames hold at most an hour of panes; groups are (account, day) with the hour before as context,
    bounded by time and not by volume.
    """
    hour_panes, five_panes = HOUR // pane_micros, FIVE_MINUTES // pane_micros
    pane = F.floor(micros(F.col("event_timestamp")) / pane_micros)
    totals = txns.groupBy("account_id", pane.alias("pane")).agg(
        F.count(F.lit(1)).alias("n"), F.sum("amount").alias("total"), F.max("amount").alias("top")
    )
    own_day = F.floor(F.col("pane") * pane_micros / DAY)
    last_day = F.floor((F.col("pane") + hour_panes - 1) * pane_micros / DAY)
    days = totals.withColumn("day", F.explode(F.sequence(own_day, last_day)))
    by_day = Window.partitionBy("account_id", "day").orderBy("pane")
    hour = by_day.rangeBetween(1 - hour_panes, -1)
    five = by_day.rangeBetween(1 - five_panes, -1)
    return (
        days.select(
            "account_id",
            "pane",
            "day",
            F.sum("n").over(hour).alias("n_between"),
            F.sum("total").over(hour).alias("sum_between"),
            F.max("top").over(hour).alias("max_between"),
            F.sum("n").over(five).alias("n5_between"),
        )
        .where(F.col("day") == own_day)
        .drop("day")
    )


def counts_by_pane(txns: DataFrame, keep: list[str], pane_micros: int = PANE) -> DataFrame:
    """Count, sum and max over [t - 1 h, t] and count over [t - 5 min, t], per event.

    Both ends belong to the frame, as do the event itself and others at the same instant. Events
    move once, to (account, pane), with copies for the two panes that they are the tail of.
    ``pane_micros`` divides five minutes and has no effect on results, only on group sizes.
    """
    if FIVE_MINUTES % pane_micros:
        raise ValueError("a pane has to divide five minutes")
    us = micros(F.col("event_timestamp"))
    pane = F.floor(us / pane_micros)
    copies = F.explode(
        F.array(
            F.struct(F.lit(_OWN).alias("role"), pane.alias("pane")),
            F.struct(F.lit(_HOUR_CONTEXT).alias("role"), (pane + HOUR // pane_micros).alias("pane")),
            F.struct(
                F.lit(_FIVE_CONTEXT).alias("role"),
                (pane + FIVE_MINUTES // pane_micros).alias("pane"),
            ),
        )
    )
    own = F.col("role") == _OWN
    hour_context = F.col("role") == _HOUR_CONTEXT
    five_context = F.col("role") == _FIVE_CONTEXT
    payload = [c for c in keep if c not in ("account_id", "amount")]
    events = txns.select("account_id", "amount", us.alias("us"), copies.alias("c"), *payload)
    events = events.select(
        "account_id",
        "amount",
        "us",
        "c.role",
        "c.pane",
        # Context rows only carry what the aggregates read.
        *[F.when(F.col("c.role") == _OWN, F.col(p)).alias(p) for p in payload],
    )
    # What lies between joins the group as one row at the start of the pane.
    between = _whole_panes(txns, pane_micros).withColumns(
        {"role": F.lit(_BETWEEN), "us": F.col("pane") * pane_micros}
    )
    rows = events.unionByName(between, allowMissingColumns=True)

    def running(order: Column):
        return (
            Window.partitionBy("account_id", "pane")
            .orderBy(order)
            .rangeBetween(Window.unboundedPreceding, Window.currentRow)
        )

    def looking_back(micros_: int) -> Column:
        # Descending: an event looks back one frame and sees the context at or after that point.
        return F.when(own, F.col("us") - micros_).otherwise(F.col("us")).desc()

    head, tail = running(F.col("us")), running(looking_back(HOUR))
    tail5 = running(looking_back(FIVE_MINUTES))

    def n(rows_: Column, over) -> Column:
        return F.count(F.when(rows_, 1)).over(over)

    def amount(rows_: Column) -> Column:
        return F.when(rows_, F.col("amount"))

    def carried(name: str) -> Column:
        return F.max(name).over(head).alias(name)

    parts = rows.withColumns(
        {
            "n_head": n(own, head),
            "sum_head": F.sum(amount(own)).over(head),
            "max_head": F.max(amount(own)).over(head),
            **{
                c: carried(c) for c in ("n_between", "sum_between", "max_between", "n5_between")
            },
        }
    ).withColumns(
        {
            "n_tail": n(hour_context, tail),
            "sum_tail": F.sum(amount(hour_context)).over(tail),
            "max_tail": F.max(amount(hour_context)).over(tail),
        }
    )
    parts = parts.withColumn("n5_tail", n(five_context, tail5)).where(own)

    def added(*names: str) -> Column:
        return reduce(lambda a, b: a + b, [F.coalesce(c, F.lit(0)) for c in names])

    largest = F.coalesce(F.greatest("max_head", "max_between", "max_tail"), F.lit(0.0))
    return parts.select(
        *keep,
        added("n_head", "n_between", "n_tail").alias("txn_count_1h"),
        F.round(added("sum_head", "sum_between", "sum_tail"), 2).alias("txn_amount_sum_1h"),
        F.round(largest, 2).alias("txn_amount_max_1h"),
        added("n_head", "n5_between", "n5_tail").alias("txn_count_5m"),
    )
