"""First visits in the stream itself: keyed state instead of a log of what was seen.

The state of an account holds the first visit and the newest event of each of its merchants, dealt to
``PARTS`` keys, so that neither a busy account is one task nor its state one value. A trigger looks up
the accounts that it brings and nothing else; no table is listed or read. Pairs that pause may be
forgotten, so state is bounded by what is active.

A call of the Python worker costs milliseconds whatever it brings. Pairs are mostly visited once, so a
key for each would cost that for nearly every event; events come as plain rows, not as small frames.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery

from tidemark.streaming.panes import WATERMARK

PARTS = 4  # keys of an account; a checkpoint keeps the number it began with

# One entry per merchant in every array; until_ms is null where pairs are not forgotten.
_STATE = (
    "merchant array<string>, first_us array<long>, first_id array<string>, "
    "newest_us array<long>, until_ms array<long>"
)


def _order(us: int, event_id: str | None) -> tuple:
    """By time, then id; no id comes first, as in a sort."""
    return us, event_id is not None, event_id or ""


@dataclass
class _Visits:
    """One merchant of an account; ``first`` as in ``_order``."""

    first: tuple
    newest: int
    until: int | None = None


class _Flags(StatefulProcessor):
    """Flags events of an account; ``_us`` is their time in microseconds, ``_merchant`` text."""

    def __init__(self, names: list[str], keep_us: int | None):
        self.names, self.keep_us = names, keep_us

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.visits = handle.getValueState("visits", _STATE)

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        pairs = self._stored()
        timer = self._end(pairs)
        touched: set[str | None] = set()
        kept: dict[str | None, list[tuple]] = {}  # events that are new unless an earlier one follows
        flagged = Row(*self.names, "is_new_merchant")
        for row in rows:
            us, merchant = row["_us"], row["_merchant"]
            order = _order(us, row["event_id"])
            event = tuple(row[name] for name in self.names)
            touched.add(merchant)
            pair = pairs.setdefault(merchant, _Visits(order, us))
            pair.newest = max(pair.newest, us)
            if order < pair.first:
                for one in kept.pop(merchant, ()):
                    yield flagged(*one, False)
                pair.first = order
            if order == pair.first:
                kept.setdefault(merchant, []).append(event)
            else:
                yield flagged(*event, False)
        for events in kept.values():
            for one in events:
                yield flagged(*one, True)
        if self.keep_us is not None:
            soonest = timerValues.getCurrentWatermarkInMs() + 1
            for merchant in touched:
                pair = pairs[merchant]
                pair.until = max((pair.newest + self.keep_us) // 1000, soonest)
        self._store(pairs, timerValues, timer)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        self._store(self._stored(), timerValues, None)
        return iter([])

    def close(self) -> None:
        pass

    def _stored(self) -> dict[str | None, _Visits]:
        known = self.visits.get()
        if known is None:
            return {}
        return {
            merchant: _Visits(_order(us, event_id), newest, until)
            for merchant, us, event_id, newest, until in zip(*known)
        }

    def _end(self, pairs: dict[str | None, _Visits]) -> int | None:
        """When the first of the pairs is forgotten."""
        ends = [p.until for p in pairs.values() if p.until is not None]
        return min(ends, default=None) if self.keep_us is not None else None

    def _store(self, pairs: dict[str | None, _Visits], timerValues, timer: int | None) -> None:
        if self.keep_us is not None:
            now = timerValues.getCurrentWatermarkInMs()
            pairs = {m: p for m, p in pairs.items() if p.until is None or p.until >= now}
            end = self._end(pairs)
            if timer != end:
                if timer is not None:
                    self.handle.deleteTimer(timer)
                if end is not None:
                    self.handle.registerTimer(end)
        if not pairs:
            self.visits.clear()
            return
        firsts = [p.first for p in pairs.values()]
        self.visits.update(
            (
                list(pairs),
                [us for us, _, _ in firsts],
                [event_id if named else None for _, named, event_id in firsts],
                [p.newest for p in pairs.values()],
                [p.until for p in pairs.values()],
            )
        )


def flag_new_merchants(
    events: DataFrame,
    watermark: str = WATERMARK,
    forget_after_days: int | None = None,
    parts: int = PARTS,
) -> DataFrame:
    """Add ``is_new_merchant`` to a stream: no earlier event of this account at this merchant.

    An event that arrives after a later one of its pair is new too if it comes before all that are
    known; repeats of a first visit are the same visit. With ``forget_after_days`` a pair is dropped
    from state once the watermark is so far past its newest event, and its next visit is new again.
    ``event_timestamp`` is wall clock in and out.
    """
    days = forget_after_days
    names = events.columns
    out = T.StructType([*events.schema.fields, T.StructField("is_new_merchant", T.BooleanType())])
    # State is timed by an instant; the events keep their own column as it is.
    at = F.col("event_timestamp").cast("timestamp")
    timed = events.withColumns(
        {
            "_at": at,
            "_us": F.unix_micros(at),
            "_merchant": F.col("merchant_id").cast("string"),
            "_part": F.pmod(F.xxhash64("merchant_id"), F.lit(parts)),
        }
    ).withWatermark("_at", watermark)
    if days is None:
        timed = timed.drop("_at")
    keep_us = None if days is None else days * 86_400_000_000
    return timed.groupBy("account_id", "_part").transformWithState(
        _Flags(names, keep_us), out, "Append", "None" if days is None else "EventTime"
    )


def write_flagged(
    events: DataFrame,
    path: str,
    checkpoint: str,
    trigger: dict | None = None,
    watermark: str = WATERMARK,
    forget_after_days: int | None = None,
) -> StreamingQuery:
    """Keep a stream's events with their flags; the file sink commits each micro-batch once."""
    return (
        flag_new_merchants(events, watermark, forget_after_days)
        .writeStream.format("parquet")
        .outputMode("append")
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"processingTime": "10 seconds"}))
        .start(path)
    )


def stream_flagged(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Flagged events as a stream; ``schema`` is that of the events."""
    flagged = T.StructType([*schema.fields, T.StructField("is_new_merchant", T.BooleanType())])
    return spark.readStream.schema(flagged).parquet(path)
