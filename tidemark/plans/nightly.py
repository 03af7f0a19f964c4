"""The nightly run for one date: build, read back, snapshot, serve, check."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from datetime import date, datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark import schemas as S
from tidemark.operators import incremental
from tidemark.operators.daily import daily_features, rolling_metrics, window_totals
from tidemark.operators.quality import quality_gate
from tidemark.operators.serving import upsert
from tidemark.operators.snapshots import stamp
from tidemark.operators.staging import clean, lookback
from tidemark.sources.feature_tables import (
    read_daily,
    replace_rolling,
    write_daily,
    write_totals,
)
from tidemark.sources.logs import append_batch, create_log
from tidemark.sources.state_tables import StateTables

SNAPSHOT = T.StructType(
    [
        *S.BATCH.fields,
        T.StructField("committed_at", T.TimestampNTZType()),
        T.StructField("snapshot_id", T.LongType()),
    ]
)


@dataclass
class Paths:
    """Where the nightly path keeps its tables."""

    totals: str
    daily: str
    rolling: str
    snapshots: str
    serving: str
    state: str

    @classmethod
    def under(cls, root: str) -> Paths:
        return cls(
            totals=f"{root}/account_window_totals",
            daily=f"{root}/account_features_daily",
            rolling=f"{root}/account_features_rolling",
            snapshots=f"{root}/{S.BATCH_SNAPSHOTS}",
            serving=f"{root}/serving",
            state=f"{root}/account_state",
        )


@dataclass(frozen=True)
class Step:
    """What one step of a run came to: done, empty or failed."""

    name: str
    state: str
    rows: int | None = None
    note: str = ""


class Stopped(Exception):
    """A step's way to end the run without an error."""


def batch_number(target_date: date | str) -> int:
    """A batch id that is the same whenever the date is run again, and grows with the date."""
    return date.fromisoformat(str(target_date)).toordinal()


def build(
    spark: SparkSession,
    txns: DataFrame,
    paths: Paths,
    target_date: date | str,
    now: datetime | str,
    by_delta: bool = False,
) -> None:
    """The daily and the rolling table of a date.

    By default the whole look-back is read. ``by_delta`` reads the date alone and the state that the
    date before has left.
    """
    cleaned = clean(txns, now)
    if by_delta:
        state = StateTables(spark, paths.state).run(cleaned, target_date)
        totals = incremental.window_totals(state, target_date)
    else:
        totals = window_totals(lookback(cleaned, target_date), target_date)
    # Both tables start from the same totals; they are stored once instead of computed twice.
    totals = write_totals(totals, paths.totals, target_date)
    if by_delta:
        features = incremental.daily_features(state, target_date, now, totals)
    else:
        features = daily_features(cleaned, target_date, now, totals=totals)
    write_daily(features, paths.daily)
    replace_rolling(rolling_metrics(cleaned, target_date, now, totals=totals), paths.rolling)


def run_daily(
    spark: SparkSession,
    txns: DataFrame,
    paths: Paths,
    target_date: date | str,
    now: datetime | str,
    by_delta: bool = False,
) -> list[Step]:
    """Run all steps for a date, in order, and say what each came to.

    Running a date again replaces its results. A failed step is the last one, and so is one that
    finds the date empty.
    """
    batch_id = batch_number(target_date)
    features: DataFrame | None = None
    served = 0

    def built() -> tuple[int | None, str]:
        build(spark, txns, paths, target_date, now, by_delta)
        return None, ""

    def fetched() -> tuple[int | None, str]:
        nonlocal features
        features = read_daily(spark, paths.daily, target_date)
        accounts = features.agg(F.count(F.lit(1)).alias("n")).first()["n"]
        if accounts == 0:
            raise Stopped(f"no account was active in the window of {target_date}")
        return accounts, ""

    def snapshotted() -> tuple[int | None, str]:
        create_log(spark, paths.snapshots, SNAPSHOT)
        return append_batch(stamp(features, batch_id, now), paths.snapshots, batch_id), ""

    def put_to_serving() -> tuple[int | None, str]:
        nonlocal served
        served = upsert(features, "batch", paths.serving, batch_id, now)
        return served, ""

    def checked() -> tuple[int | None, str]:
        rows = quality_gate(features, served).collect()  # three rows
        found = ", ".join(f"{row['check_name']}: {row['status']}" for row in rows)
        if any(row["status"] == "fail" for row in rows):
            raise RuntimeError(found)
        return None, found

    steps: list[tuple[str, Callable[[], tuple[int | None, str]]]] = [
        ("build", built),
        ("fetch", fetched),
        ("snapshot", snapshotted),
        ("serving", put_to_serving),
        ("quality", checked),
    ]
    done: list[Step] = []
    for name, step in steps:
        try:
            done.append(Step(name, "done", *step()))
        except Stopped as e:
            return [*done, Step(name, "empty", 0, str(e))]
        except Exception as e:
            return [*done, Step(name, "failed", None, f"{type(e).__name__}: {e}")]
    return done
