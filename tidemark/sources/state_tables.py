"""Where nightly state and day partials are kept: one folder per table and date.

    root/partials/<table>/transaction_date=<day>     a day's own rows
    root/state/<table>/computation_date=<date>       what the window holds after a date

A date's folders are replaced as a whole, so a date can be run again. Readers name the folder of the
date they need; no other date is listed or read.
"""

from __future__ import annotations

from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from datetime import date, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.clock import day
from tidemark.operators import incremental as inc
from tidemark.sources.logs import path_exists, remove_path

_PARTIALS = {
    "days": "account_id string, n bigint, amount double, online bigint",
    "merchants": "account_id string, merchant_id string",
    "categories": "account_id string, merchant_category string, n bigint",
    "amounts": "account_id string, amount double, n bigint",
}
_STATE = {
    "days": "account_id string, "
    "days array<struct<day: date, n: bigint, amount: double, online: bigint>>",
    "merchants": "account_id string, merchant_id string, last_date date",
    "categories": "account_id string, merchant_category string, n bigint",
    "amounts": "account_id string, amount double, n bigint",
}


def _together(jobs: list[Callable[[], None]]) -> None:
    """Independent writes at once, so that a small one doesn't wait for a large one."""
    with ThreadPoolExecutor(len(jobs)) as pool:
        for done in [pool.submit(job) for job in jobs]:
            done.result()


class StateTables:
    """The folders of one nightly state."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root

    def _write(self, tables: inc.Tables, kind: str, column: str, many: bool = False) -> None:
        def job(name: str, rows: DataFrame) -> Callable[[], None]:
            # Of many dates each goes to few tasks, so that not every task writes every folder.
            dealt = rows.repartitionByRange(column, "account_id") if many else rows
            return lambda: (
                dealt.sortWithinPartitions(column, "account_id")
                .write.mode("overwrite")
                .option("partitionOverwriteMode", "dynamic")
                .partitionBy(column)
                .parquet(f"{self.root}/{kind}/{name}")
            )

        _together([job(name, rows) for name, rows in tables.named().items()])

    def write_partials(self, parts: inc.Tables, first: date | str, last: date | str) -> None:
        """Store the partials of a range of days; a day without rows is stored as empty."""
        self._forget("partials", "transaction_date", first, last)
        self._write(parts, "partials", "transaction_date", many=str(first) != str(last))

    def write_state(self, state: inc.Tables, upto: date | str) -> None:
        """``upto``'s state; it may not be computed from what it replaces."""
        dated = {
            name: rows.withColumn("computation_date", day(upto))
            for name, rows in state.named().items()
        }
        self._forget("state", "computation_date", upto, upto)
        self._write(inc.Tables(**dated), "state", "computation_date")
        # Even an empty state is there: its folders are what says that the date was run.
        for name, schema in _STATE.items():
            path = self._folder("state", name, "computation_date", upto)
            if not path_exists(self.spark, path):
                self.spark.createDataFrame([], schema).write.parquet(path)

    def _folder(self, kind: str, name: str, column: str, at: date | str) -> str:
        return f"{self.root}/{kind}/{name}/{column}={at}"

    def _forget(self, kind: str, column: str, first: date | str, last: date | str) -> None:
        at, end = date.fromisoformat(str(first)), date.fromisoformat(str(last))
        while at <= end:
            for name in inc.TABLES:
                path = self._folder(kind, name, column, at)
                if path_exists(self.spark, path):
                    remove_path(self.spark, path)
            at += timedelta(days=1)

    def partials(self, first: date | str, last: date | str | None = None) -> inc.Tables:
        """Stored partials of a day, or of a range of days; days that were never stored have none."""
        at, end = date.fromisoformat(str(first)), date.fromisoformat(str(last or first))
        dates = [at + timedelta(days=k) for k in range((end - at).days + 1)]

        def read(name: str) -> DataFrame:
            found = [
                path
                for d in dates
                if path_exists(
                    self.spark, path := self._folder("partials", name, "transaction_date", d)
                )
            ]
            schema = f"{_PARTIALS[name]}, transaction_date date"
            if not found:
                return self.spark.createDataFrame([], schema)
            base = f"{self.root}/partials/{name}"
            return self.spark.read.schema(schema).option("basePath", base).parquet(*found)

        return inc.Tables(*[read(name) for name in inc.TABLES])

    def has_state(self, upto: date | str) -> bool:
        return all(
            path_exists(self.spark, self._folder("state", name, "computation_date", upto))
            for name in inc.TABLES
        )

    def state(self, upto: date | str) -> inc.Tables:
        """The stored state after a date; a date that was never run is an error."""
        return inc.Tables(
            *[
                self.spark.read.schema(_STATE[name]).parquet(
                    self._folder("state", name, "computation_date", upto)
                )
                for name in inc.TABLES
            ]
        )

    def run(self, txns: DataFrame, upto: date | str) -> inc.Tables:
        """Bring the state to a date of cleaned transactions and return it as stored.

        With the state of the day before, one day of ``txns`` is read, and one stored day retires.
        Without it the whole window is read once.
        """
        end = date.fromisoformat(str(upto))
        before = end - timedelta(days=1)
        if self.has_state(before):
            self.write_partials(inc.partials(txns, end), end, end)
            gone = self.partials(inc.retired_day(end))
            state = inc.advance(self.state(before), self.partials(end), gone, end)
        else:
            start = end - timedelta(days=inc.KEPT_DAYS)
            self.write_partials(inc.partials(txns, start, end), start, end)
            state = inc.first_state(self.partials(start, end), end)
        self.write_state(state, end)
        return self.state(end)

    def drop_before(self, oldest: date | str, days: int = 400) -> None:
        """Remove the states before a date, and the partials that no later date retires.

        States are what a correction starts from; keep as many as corrections may reach back. Looks
        back over so many days.
        """
        end = date.fromisoformat(str(oldest)) - timedelta(days=1)
        self._forget("state", "computation_date", end - timedelta(days=days), end)
        # The state of the oldest date stays, so the next date to run retires oldest - 90 days.
        last = inc.retired_day(end + timedelta(days=2)) - timedelta(days=1)
        self._forget("partials", "transaction_date", last - timedelta(days=days), last)
