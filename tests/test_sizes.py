"""What queries read, store and sort once, whatever the size of their tables."""

import pytest
from pyspark.sql.classic.dataframe import DataFrame

from tidemark.plans import delivery_queries, nightly, queries, stored_queries


class Seen(Exception):
    pass


def test_the_delta_run_reads_its_source_by_day(spark, folder, monkeypatch):
    def build(spark, txns, *args, **kwargs):
        raise Seen(txns.inputFiles())

    monkeypatch.setattr(nightly, "build", build)
    with pytest.raises(Seen) as seen:
        stored_queries.nightly_delta(spark, folder)
    files = seen.value.args[0]
    days = {f.split("transaction_date=")[1][:10] for f in files}
    assert min(days) >= "1998-04-21" and max(days) <= "1998-07-29"


def test_the_message_cap_sorts_nothing(spark, folder, monkeypatch):
    def refuse(*args, **kwargs):
        raise Seen

    monkeypatch.setattr(DataFrame, "sortWithinPartitions", refuse)
    row = delivery_queries.message_cap(spark, folder).first()
    assert row.whole_batches and row.cap_reached and row.all_taken_are_stored


def test_statements_store_only_what_they_read(spark, folder, monkeypatch):
    def refuse(*args, **kwargs):
        raise Seen

    monkeypatch.setattr(delivery_queries, "write_daily", refuse)
    assert not delivery_queries.sql_as_of(spark, folder).isEmpty()


@pytest.mark.parametrize("name", ["q_velocity_5m", "q_realtime_vector"])
def test_pane_queries_start_with_many_partitions(spark, folder, name):
    conf = queries.registered()[name](spark, folder).sparkSession.conf
    assert int(conf.get("spark.sql.adaptive.coalescePartitions.initialPartitionNum")) >= 1024
    assert conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes") == "16m"


@pytest.mark.parametrize("name", ["late_rows", "stream_updates", "stream_dedup"])
def test_a_second_run_copies_state_and_replays_no_changelog(spark, folder, name, monkeypatch, tmp_path):
    monkeypatch.setattr(stored_queries, "run_dir", lambda spark, name: str(tmp_path / name))
    assert not getattr(stored_queries, name)(spark, folder).isEmpty()
    state = tmp_path / "runs" / "ck" / "state"
    assert list(state.rglob("*.zip")) and not list(state.rglob("*.changelog"))
