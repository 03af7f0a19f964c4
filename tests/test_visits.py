from datetime import timedelta

import pytest
from pyspark.sql import functions as F

from tests.helpers import T0, frame, minutes, txn
from tidemark import schemas as S
from tidemark.operators import hopping, serving, staging, trailing
from tidemark.plans.queries import NOW
from tidemark.session import stream_session
from tidemark.sources import tables
from tidemark.streaming import ingest, panes, visits

ONCE = {"availableNow": True}


class Flags:
    """A flag stream over a folder of events, one run per call."""

    def __init__(self, spark, root, **options):
        self.spark, self.root, self.options = stream_session(spark, 4), str(root), options

    def run(self, rows):
        df = rows if hasattr(rows, "columns") else frame(self.spark, rows)
        df.coalesce(1).write.mode("append").parquet(f"{self.root}/in")
        events = self.spark.readStream.schema(S.TRANSACTION).parquet(f"{self.root}/in")
        query = visits.write_flagged(
            events, f"{self.root}/out", f"{self.root}/ck", ONCE, **self.options
        )
        query.awaitTermination()
        return query

    def new(self):
        rows = self.spark.read.parquet(f"{self.root}/out").where("is_new_merchant").collect()
        return sorted((r.event_id is not None, r.event_id) for r in rows)

    def ids(self):
        return [event_id for _, event_id in self.new()]


def test_flags_over_runs_and_a_restart_equal_the_batch_flags(spark, folder, tmp_path):
    flags = Flags(spark, tmp_path)
    rows = staging.clean(tables.transactions(spark, folder), NOW)
    days = F.dayofmonth("event_timestamp")
    for part in (rows.where(days <= 10), rows.where((days > 10) & (days <= 20)), rows.where(days > 20)):
        flags.run(part)
    got = spark.read.parquet(f"{tmp_path}/out").select("event_id", "is_new_merchant")
    want = trailing.is_new_merchant(rows).select("event_id", "is_new_merchant")
    assert got.exceptAll(want).isEmpty() and want.exceptAll(got).isEmpty()


def test_order_ties_repeats_and_missing_values(spark, tmp_path):
    flags = Flags(spark, tmp_path)
    flags.run(
        [
            txn("b", at=minutes(5)),
            txn("a", at=minutes(5)),  # the same moment: the smaller id came first
            txn("c", at=minutes(9)),
            txn("n", merchant=None),
            txn("o", merchant=None, at=minutes(1)),
            txn(None, account="z", at=minutes(2)),
            txn("y", account="z", at=minutes(2)),
        ]
    )
    assert flags.ids() == [None, "a", "n"]
    # Earlier than all that is known, a repeat of the first visit, and a later one.
    flags.run([txn("early", at=minutes(4)), txn("a", at=minutes(5)), txn("d", at=minutes(30))])
    assert flags.ids() == [None, "a", "early", "n"]
    flags.run([txn("early", at=minutes(4)), txn("e", at=minutes(31))])
    assert flags.ids() == [None, "a", "early", "early", "n"]


def test_a_pause_makes_a_pair_new_again(spark, tmp_path):
    flags = Flags(spark, tmp_path, forget_after_days=2, watermark="1 minute")
    day = timedelta(days=1)
    flags.run([txn("e1"), txn("f1", merchant="other")])
    flags.run([txn("e2", at=T0 + day)])
    flags.run([txn("x", account="b", at=T0 + 2.5 * day)])  # moves the watermark past the other pair
    query = flags.run([txn("y", account="b", merchant="q", at=T0 + 2.6 * day)])
    flags.run([txn("e3", at=T0 + 2.7 * day), txn("f2", merchant="other", at=T0 + 2.7 * day)])
    assert flags.ids() == ["e1", "f1", "f2", "x", "y"]
    assert query.recentProgress[-1]["stateOperators"][0]["numRowsTotal"] <= 4


def test_a_group_in_several_chunks(spark, tmp_path):
    size = "spark.sql.execution.arrow.maxRecordsPerBatch"
    flags = Flags(spark, tmp_path)
    flags.spark.conf.set(size, "7")
    flags.run([txn(f"e{m:02d}", at=minutes(60 - m)) for m in range(50)] + [txn("e49", at=minutes(11))])
    assert flags.ids() == ["e49", "e49"]


def test_a_trigger_reads_no_table_of_visits(spark, tmp_path):
    flags = Flags(spark, tmp_path)
    flags.run([txn(f"e{i}", account=f"a{i}") for i in range(5)])
    query = flags.run([txn("x", account="a1", at=minutes(3))])
    progress = [p for p in query.recentProgress if p["numInputRows"]]
    assert [s["numInputRows"] for p in progress for s in p["sources"]] == [1]
    assert progress[-1]["stateOperators"][0]["numRowsUpdated"] == 1


def test_merchants_of_an_account_share_a_few_keys_of_state(spark, tmp_path):
    flags = Flags(spark, tmp_path)
    query = flags.run([txn(f"e{i:02d}", merchant=f"m{i}", at=minutes(i)) for i in range(40)])
    assert query.recentProgress[-1]["stateOperators"][0]["numRowsUpdated"] <= visits.PARTS
    flags.run([txn(f"f{i:02d}", merchant=f"m{i}", at=minutes(20)) for i in range(41)])
    # Up to the 20th minute the merchants are known; after it, what came later is overtaken.
    assert flags.ids() == [f"e{i:02d}" for i in range(40)] + [f"f{i:02d}" for i in range(21, 41)]


@pytest.mark.parametrize("flagged", [True, False])
def test_the_sink_serves_the_flag_of_the_newest_event(spark, tmp_path, flagged):
    rows = [txn("e1"), txn("e2", at=minutes(5)), txn("e3", account="b", at=minutes(6))]
    events = frame(spark, rows)
    carried = panes.FLAG if flagged else ()
    if flagged:
        events = trailing.is_new_merchant(events)
    end = (F.floor(F.unix_seconds(F.col("event_timestamp").cast("timestamp")) / 10) + 1) * 10
    batch = events.groupBy("account_id", end.alias("pane_end")).agg(*hopping.pane_aggregates(carried))
    timed = batch.withColumn(
        "newest",
        F.col("newest").withField(
            "event_timestamp", F.col("newest.event_timestamp").cast("timestamp")
        ),
    )
    paths = panes.Paths.under(str(tmp_path))
    panes.make_sink(paths, clock=lambda: T0)(timed, 0)
    served = serving.read_serving(spark, paths.serving, "realtime").collect()
    want = {"a": False, "b": True} if flagged else {"a": False, "b": False}
    assert {r.account_id: r.is_new_merchant for r in served} == want


def test_the_table_of_first_visits_is_still_kept(spark, tmp_path):
    source, out = str(tmp_path / "in"), str(tmp_path / "out")
    frame(spark, [txn(None, merchant=None), txn("e2", account="b", merchant=None)]).write.parquet(source)
    events = spark.readStream.schema(S.TRANSACTION).parquet(source)
    ingest.write_first_visits(events, out, str(tmp_path / "ck"), ONCE).awaitTermination()
    got = ingest.read_first_visits(spark, out).collect()
    assert {(r.account_id, r.merchant_id, r.event_id) for r in got} == {("a", None, None), ("b", None, "e2")}
