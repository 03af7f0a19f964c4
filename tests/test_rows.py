import json

import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tests.helpers import event, messages
from tidemark.operators.quality import EXHAUSTED, outcome_stats
from tidemark.streaming import rows

AMOUNT = T.StructType([T.StructField("doubled", T.DoubleType())])
ONCE = {"availableNow": True}


def doubling(batch):
    if any(i.startswith("bad") for i in batch.column("event_id").to_pylist()):
        raise ValueError("no luck")
    return pa.RecordBatch.from_arrays(
        [pa.array([2 * a for a in batch.column("amount").to_pylist()])], ["doubled"]
    )


def test_halving_leaves_the_failing_rows_alone():
    calls = []

    def handler(batch):
        calls.append(batch.num_rows)
        if 13 in batch.column("x").to_pylist():
            raise ValueError("unlucky")
        return batch

    batch = pa.RecordBatch.from_pydict({"x": list(range(1000)) + [13]})
    found = rows.attempt(handler, batch, 2, 0.0)
    assert sorted((a, n) for a, n, _, _ in found) == sorted(
        {(a, n) for a, n, _, _ in found}
    ) and sum(n for _, n, _, _ in found) == 1001
    bad = [(a, n, e, k) for a, n, e, k in found if isinstance(e, str)]
    assert [(a, n, k) for a, n, _, k in sorted(bad)] == [(13, 1, 2), (1000, 1, 2)]
    assert all(e == "ValueError: unlucky" for _, _, e, _ in bad)
    assert len(calls) < 2 * 2 * 11 + 8


def test_a_passing_failure_is_tried_again():
    calls = []

    def handler(batch):
        calls.append(batch.num_rows)
        if len(calls) < 3:
            raise OSError("away")
        return batch

    batch = pa.RecordBatch.from_pydict({"x": [1, 2, 3]})
    ((at, n, got, tries),) = rows.attempt(handler, batch, 3, 0.0)
    assert (at, n, tries) == (0, 3, 3) and got.num_rows == 3
    assert rows.attempt(handler, batch.slice(0, 0), 3, 0.0) == []


def test_too_few_rows_back_is_a_failure():
    batch = pa.RecordBatch.from_pydict({"x": [1, 2]})
    found = rows.attempt(lambda b: b.slice(0, 0), batch, 1, 0.0)
    assert [e for _, _, e, _ in found] == ["ValueError: 0 rows came back for 1"] * 2


def test_every_outcome_in_one_pass(spark):
    values = [event(event_id=f"e{i}", amount=i) for i in range(20)]
    values += [event(event_id="bad1"), event(amount=-1), "{oops", None, event(event_id="bad2")]
    got = rows.handled(messages(spark, values).repartition(3), doubling, AMOUNT, 2).cache()
    assert got.count() == 25
    done = got.where("outcome = 'done'")
    assert sorted(r.doubled for r in done.collect()) == [2.0 * i for i in range(20)]
    assert done.where("original_message IS NOT NULL OR error IS NOT NULL").isEmpty()
    stats = outcome_stats(got).first()
    assert (stats.processed, stats.failed, stats.dlq_routed) == (20, 2, 5)
    dead = {r.source_offset: r for r in rows.set_aside(got, "2024-01-01 00:00:00").collect()}
    assert set(dead) == {20, 21, 22, 23, 24}
    assert dead[20].error_reason == EXHAUSTED
    assert dead[20].metadata == {"error": "ValueError: no luck", "attempts": "2"}
    assert json.loads(dead[24].original_message)["event_id"] == "bad2"
    assert dead[21].error_reason == "Validation error: amount" and dead[21].metadata == {}
    empty = rows.handled(messages(spark, values).limit(0), doubling, AMOUNT)
    assert empty.isEmpty() and empty.schema == got.schema


def test_jobs_do_not_grow_with_the_bad_messages(spark, tmp_path):
    """100,000 messages with 1,000 bad ones take as many Spark jobs as with none."""
    body = event(event_id="...")
    tracker = spark.sparkContext.statusTracker()

    def run(name, every):
        ids = spark.range(0, 100_000, 1, 4).select(
            F.concat(
                F.when(F.col("id") % every == 0, "bad").otherwise("e"), F.col("id").cast("string")
            ).alias("event_id"),
            "id",
        )
        text = F.replace(F.lit(json.dumps(body)), F.lit("..."), F.col("event_id"))
        raw = ids.select(
            text.alias("value"),
            F.lit("topic").alias("topic"),
            F.lit(0).alias("partition"),
            F.col("id").alias("offset"),
        )
        spark.sparkContext.setJobGroup(name, name)
        rows.write_batch(raw, doubling, AMOUNT, f"{tmp_path}/{name}", 0, 2, 0.0)
        jobs = len(tracker.getJobIdsForGroup(name))
        spark.sparkContext.setJobGroup("", "")
        return jobs, rows.read_handled(spark, f"{tmp_path}/{name}", AMOUNT)

    clean_jobs, clean = run("clean", 1_000_000_000)
    jobs, mixed = run("mixed", 100)
    assert jobs == clean_jobs <= 2
    assert clean.where("outcome = 'failed'").count() <= 1
    assert mixed.where("outcome = 'failed'").count() == 1000
    assert mixed.where("outcome = 'done'").count() == 99_000


def test_a_stream_and_its_replay(spark, tmp_path):
    path, source = str(tmp_path / "out"), str(tmp_path / "in")
    values = [event(event_id=f"e{i}") for i in range(6)] + [event(event_id="bad")]
    raw = messages(spark, values)
    raw.coalesce(1).write.parquet(source)
    stream = spark.readStream.schema(raw.schema).parquet(source)
    rows.write_handled(
        stream, doubling, AMOUNT, path, str(tmp_path / "ck"), ONCE, 2, 0.0
    ).awaitTermination()
    for _ in range(2):
        rows.write_batch(raw, doubling, AMOUNT, path, 0, 2, 0.0)
        stored = rows.read_handled(spark, path, AMOUNT)
        assert stored.groupBy("outcome").count().collect() and stored.count() == 7
    failed = stored.where("outcome = 'failed'")
    plan = failed._jdf.queryExecution().executedPlan().toString()
    assert failed.count() == 1 and "(outcome#" in plan[plan.index("PartitionFilters") :][:120]


@pytest.mark.parametrize("wrong", [None, "text"])
def test_what_does_not_fit_the_schema_stops_the_job(spark, wrong):
    def handler(batch):
        return pa.RecordBatch.from_arrays([pa.array([{"a": wrong}] * batch.num_rows)], ["doubled"])

    with pytest.raises(Exception):
        rows.handled(messages(spark, [event()]), handler, AMOUNT, 1).collect()
