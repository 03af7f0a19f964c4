from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from tests.helpers import frame, same, txn
from tidemark.operators import daily, incremental, staging
from tidemark.plans import nightly
from tidemark.sources.state_tables import StateTables

NOW = "2025-01-01 00:00:00"
START = date(2024, 1, 1)


def at(n, hour=12):
    day = START + timedelta(days=n)
    return {"event_timestamp": f"{day} {hour}:00:00", "transaction_date": day}


@pytest.fixture(scope="module")
def txns(spark):
    """Accounts that are busy, pause, come back after the window, or have one day only."""
    rows, k = [], 0

    def add(n, account, amount, merchant, category="retail", online=False):
        nonlocal k
        k += 1
        day = START + timedelta(days=n)
        from datetime import datetime

        rows.append(
            txn(
                f"e{k}", account, datetime(day.year, day.month, day.day, 1 + k % 20), amount, merchant,
                merchant_category=category, is_online=online,
            )
        )

    for n in range(0, 130):
        add(n, "busy", 0.1 * n + 0.7, f"m{n % 9}", ["a", "b", None][n % 3], n % 2 == 0)
        add(n, "busy", 3.3, "m0", "a")
    for n in (0, 1, 40, 97, 126):
        add(n, "pauses", 10.0 + n, "m1" if n < 50 else "m2", "a" if n < 50 else "b", True)
    add(3, "once", 5.0, None, None)
    add(92, "late", 1e9, "m5", "z")
    add(92, "late", 1e-9, "m5", "z")
    return staging.clean(frame(spark, rows), NOW)


def settled(df):
    return df.withColumns({n: F.round(n, 8) for n, t in df.dtypes if t == "double"})


def check(state, txns, day):
    got = settled(incremental.daily_features(state, day, NOW))
    assert same(got, settled(daily.daily_features(txns, day, NOW)))
    rolling = settled(incremental.rolling_metrics(state, day, NOW))
    assert same(rolling, settled(daily.rolling_metrics(txns, day, NOW)))


def test_dates_in_a_row_equal_the_whole_look_back(spark, txns, tmp_path):
    tables = StateTables(spark, str(tmp_path))
    for n in range(88, 98):  # the first days retire from the 91st date on
        day = START + timedelta(days=n)
        state = tables.run(txns, day)
        if n in (88, 90, 91, 93, 94, 97):
            check(state, txns, day)
    assert state.amounts.agg(F.min("n")).first()[0] > 0


def test_a_date_reads_its_day_and_the_state_before_it(spark, txns, tmp_path):
    source = str(tmp_path / "txns")
    txns.write.partitionBy("transaction_date").parquet(source)
    stored = spark.read.schema(txns.schema).parquet(source)
    tables = StateTables(spark, str(tmp_path / "state"))
    day = START + timedelta(days=95)
    tables.run(stored, day - timedelta(days=1))

    def read(parts):
        return {
            f.split("transaction_date=")[1].split("/")[0]
            for table in parts.named().values()
            for f in table.inputFiles()
        }

    came = incremental.partials(stored, day)
    for table in came.named().values():
        plan = table._jdf.queryExecution().executedPlan().toString()
        filters = [line for line in plan.splitlines() if "FileScan" in line]
        assert filters and all(f"PartitionFilters: [isnotnull(transaction_date" in f for f in filters)
    state = tables.run(stored, day)
    assert all(
        f"computation_date={day}" in f for t in state.named().values() for f in t.inputFiles()
    )
    # What advances the state: the day itself, the state of the day before, and one retired day.
    before, gone = tables.state(day - timedelta(days=1)), tables.partials(incremental.retired_day(day))
    assert read(gone) == {str(START + timedelta(days=4))}
    next_state = incremental.advance(before, tables.partials(day), gone, day)
    folders = {
        part
        for table in next_state.named().values()
        for f in table.inputFiles()
        for part in f.split("/")
        if "_date=" in part
    }
    assert folders == {
        f"transaction_date={day}",
        f"transaction_date={START + timedelta(days=4)}",
        f"computation_date={day - timedelta(days=1)}",
    }


def test_a_correction_leaves_nothing_behind(spark, txns, tmp_path):
    tables = StateTables(spark, str(tmp_path))
    days = [START + timedelta(days=n) for n in (100, 101, 102)]
    for day in days:
        tables.run(txns, day)
    gone = F.col("transaction_date") == days[1]
    corrected = txns.where(~gone | (F.col("account_id") != "busy")).unionByName(
        txns.where(gone & (F.col("account_id") == "busy")).limit(1).withColumn("amount", F.lit(77.0))
    )
    for day in days[1:]:
        state = tables.run(corrected, day)
    check(state, corrected, days[2])
    again = tables.run(corrected, days[2])
    check(again, corrected, days[2])


def test_the_day_that_retires_is_the_one_that_was_stored(spark, txns, tmp_path):
    """The source of a day changes long after it was added; the state stays without remainders."""
    tables = StateTables(spark, str(tmp_path))
    tables.run(txns, START + timedelta(days=90))
    later = txns.where(F.col("transaction_date") != START)
    state = tables.run(later, START + timedelta(days=91))
    check(state, later, START + timedelta(days=91))


def test_empty_days_and_old_states(spark, txns, tmp_path):
    tables = StateTables(spark, str(tmp_path))
    days = [START + timedelta(days=n) for n in range(128, 133)]  # no rows from day 130 on
    for day in days:
        state = tables.run(txns, day)
    check(state, txns, days[-1])
    assert tables.partials(days[-1]).days.isEmpty()
    tables.drop_before(days[2])
    assert not tables.has_state(days[1]) and tables.has_state(days[2])
    state = tables.run(txns, days[3])
    check(state, txns, days[3])
    none = StateTables(spark, str(tmp_path / "none"))
    assert none.run(txns, "2020-01-01").days.isEmpty()
    assert none.run(txns, "2020-01-02").amounts.isEmpty()


def test_nightly_run_by_delta(spark, txns, tmp_path):
    paths = nightly.Paths.under(str(tmp_path))
    whole = nightly.Paths.under(str(tmp_path / "whole"))
    for n in (109, 110):
        day = START + timedelta(days=n)
        steps = nightly.run_daily(spark, txns, paths, day, NOW, by_delta=True)
        assert [s.state for s in steps] == ["done"] * 5, steps
        assert nightly.run_daily(spark, txns, whole, day, NOW) == steps
    for a, b in ((paths.daily, whole.daily), (paths.rolling, whole.rolling)):
        assert same(settled(spark.read.parquet(a)), settled(spark.read.parquet(b)))
