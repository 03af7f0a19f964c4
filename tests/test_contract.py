import duckdb
import glob
import os

import pytest

import __spark_entry__ as contract
import check_oracles

COMPARED = [
    "q_validate_events",
    "q_dead_letter",
    "q_staging",
    "q_realtime_vector",
    "q_hop_1h",
    "q_daily_features",
    "q_history_rolling",
    "q_bootstrap_features",
    "q_asof_training_set",
    "q_feature_diff",
    "q_feature_vector",
    "q_delete_account",
]


@pytest.fixture(scope="module")
def db():
    connection = duckdb.connect()
    for file in glob.glob("/root/testdata/sf0.001/*.parquet"):
        name = os.path.basename(file)[: -len(".parquet")]
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{file}')")
    return connection


def test_every_query_over_transactions_has_sql():
    named = {n for n in contract.queries() if n.startswith("q_")}
    assert named and named <= set(contract.oracle_sql())


def test_stream_queries_read_a_folder_of_part_files(spark, folder, tmp_path):
    for file in glob.glob(f"{folder}/*.parquet"):
        os.symlink(file, tmp_path / os.path.basename(file))
    os.remove(tmp_path / "events.parquet")
    events = spark.read.parquet(f"{folder}/events.parquet").repartition(3)
    events.write.parquet(str(tmp_path / "events.parquet"))
    name = "q_stream_first_visits"
    one, many = (contract.queries()[name](spark, str(f)) for f in (folder, tmp_path))
    assert one.count() == many.count() > 0
    assert one.exceptAll(many).isEmpty()


def test_entry_has_a_stable_schema(spark):
    first, second = contract.entry(spark), contract.entry(spark)
    assert first.schema == second.schema and first.count() == 15


@pytest.mark.parametrize("name", COMPARED)
def test_query_equals_its_sql(spark, folder, db, name):
    df = contract.queries()[name](spark, folder)
    result = db.execute(contract.oracle_sql()[name])
    columns = [d[0] for d in result.description]
    assert sorted(columns) == sorted(df.columns)
    theirs = check_oracles.rows_of(result.fetchall(), columns)
    assert check_oracles.rows_of(df.collect(), df.columns) == theirs
