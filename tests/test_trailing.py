import random
from datetime import timedelta

import pytest
from pyspark.sql import functions as F

from tests.helpers import T0, frame, minutes, txn
from tidemark import schemas as S
from tidemark.operators import hopping, trailing


def _profiles(spark, rows):
    return spark.createDataFrame(
        rows, "account_id string, home_latitude double, home_longitude double"
    )


def test_five_event_window(spark):
    rows = [txn("e0", at=minutes(30), amount=42.99, merchant="s")]
    rows += [txn(f"e{i + 1}", at=minutes(i * 10), amount=10.0 + i * 5, merchant=f"m{i}") for i in range(4)]
    got = {r.event_id: r for r in trailing.trailing_features(frame(spark, rows)).collect()}
    last = got["e0"]
    assert last.txn_count_1h == 5
    assert last.txn_amount_sum_1h == 112.99 and last.txn_amount_max_1h == 42.99
    assert last.txn_velocity_5m == 1.0
    assert last.hour_of_day == 14 and last.is_weekend is False
    assert last.is_new_merchant is True
    assert last.distance_from_home is None
    assert last.is_online is False and last.card_present is True and last.country_code == "US"


def test_both_ends_belong_to_the_frame(spark):
    us = timedelta(microseconds=1)
    rows = [
        txn("at", at=minutes(60)),
        txn("edge", at=minutes(0)),
        txn("past", at=minutes(0) - us),
        txn("five", at=minutes(55)),
        txn("six", at=minutes(55) - us),
        txn("peer", at=minutes(60)),
        txn("next", at=minutes(60) + us),
    ]
    got = {r.event_id: r for r in trailing.trailing_counts(frame(spark, rows), ["event_id"]).collect()}
    assert (got["at"].txn_count_1h, got["at"].txn_count_5m) == (5, 3)
    assert (got["peer"].txn_count_1h, got["peer"].txn_count_5m) == (5, 3)
    assert got["next"].txn_count_1h == 5


def test_trailing_counts_against_brute_force(spark):
    rng = random.Random(3)
    rows = []
    for i in range(700):
        # One account holds a good third of the rows, and many share an instant.
        account = "hot" if rng.random() < 0.4 else f"a{rng.randrange(12)}"
        at = T0 + timedelta(seconds=rng.choice([rng.randrange(4 * 3600), 300 * rng.randrange(48)]))
        rows.append(txn(f"e{i}", account, at, round(rng.uniform(0, 200), 2)))
    counted = trailing.trailing_counts(frame(spark, rows), ["event_id"]).collect()
    assert len(counted) == len(rows)
    got = {r.event_id: r for r in counted}
    for r in rows:
        t = r["event_timestamp"]
        seen = [
            o
            for o in rows
            if o["account_id"] == r["account_id"]
            and t - timedelta(hours=1) <= o["event_timestamp"] <= t
        ]
        five = [o for o in seen if o["event_timestamp"] >= t - timedelta(minutes=5)]
        g = got[r["event_id"]]
        assert g.txn_count_1h == len(seen) and g.txn_count_5m == len(five)
        assert abs(g.txn_amount_sum_1h - sum(o["amount"] for o in seen)) < 0.006
        assert g.txn_amount_max_1h == max(o["amount"] for o in seen)


def test_trailing_counts_take_one_shuffle(spark):
    plan = trailing.trailing_counts(frame(spark, [txn("e")]), ["event_id"])
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert text.count("Exchange hashpartitioning") == 1


def test_new_merchant_with_and_without_history(spark):
    rows = [
        txn("e1", at=minutes(0), merchant="x"),
        txn("e2", at=minutes(1), merchant="x"),
        txn("e3", at=minutes(2), merchant="y"),
        txn("e4", account="b", at=minutes(3), merchant="x"),
        txn("e5", at=minutes(0), merchant="x"),
    ]
    df = frame(spark, rows)
    got = {r.event_id: r.is_new_merchant for r in trailing.is_new_merchant(df).collect()}
    assert got == {"e1": True, "e2": False, "e3": True, "e4": True, "e5": False}
    known = spark.createDataFrame([("a", "y"), ("a", "y")], "account_id string, merchant_id string")
    got = {r.event_id: r.is_new_merchant for r in trailing.is_new_merchant(df, known).collect()}
    assert got == {"e1": True, "e2": False, "e3": False, "e4": True, "e5": False}


def test_distance_from_home(spark):
    rows = [
        txn("e1", latitude=40.7128, longitude=-74.0060),
        txn("e2", account="b", latitude=40.7128, longitude=-74.0060),
        txn("e3", account="c", latitude=40.7128, longitude=-74.0060),
        txn("e4"),
    ]
    homes = _profiles(spark, [("a", 40.7580, -73.9855), ("b", None, -73.9)])
    out = trailing.distance_from_home(frame(spark, rows), homes).collect()
    got = {r.event_id: r.distance_from_home for r in out}
    assert 4 < got["e1"] < 6
    assert got["e2"] is None and got["e3"] is None and got["e4"] is None
    full = trailing.trailing_features(frame(spark, rows), homes).where("event_id = 'e1'").first()
    assert full.distance_from_home == got["e1"]


def test_last_values_break_ties_by_event_id(spark):
    rows = [
        txn("e1", at=minutes(5), merchant="x", country_code="CA"),
        txn("e2", at=minutes(5), merchant="y", is_online=True),
        txn("e0", at=minutes(1), merchant="z"),
    ]
    row = trailing.last_values(frame(spark, rows)).first()
    assert (row.last_merchant_id, row.last_is_online, row.last_country_code) == ("y", True, "US")


def test_panes_equal_the_literal_sliding_window(spark, folder):
    from tidemark.operators.staging import clean
    from tidemark.sources import tables

    txns = clean(tables.transactions(spark, folder), "2024-02-05 00:00:00")
    timed = txns.withColumn("event_timestamp", F.col("event_timestamp").cast("timestamp"))
    literal = timed.groupBy("account_id", F.window("event_timestamp", "1 hour", "10 seconds")).agg(
        F.count(F.lit(1)).alias("txn_count_1h"),
        F.round(F.sum("amount"), 2).alias("txn_amount_sum_1h"),
        F.round(F.max("amount"), 2).alias("txn_amount_max_1h"),
    )
    literal = literal.select(
        "account_id",
        F.col("window.end").cast("timestamp_ntz").alias("window_end"),
        "txn_count_1h",
        "txn_amount_sum_1h",
        "txn_amount_max_1h",
    )
    ours = hopping.hop_features(txns).select(*literal.columns)
    assert ours.count() == 1000
    assert ours.exceptAll(literal).count() == 0


def test_windows_reach_over_midnight(spark):
    night = T0.replace(hour=23, minute=30)
    rows = [txn(f"e{i}", at=night + timedelta(minutes=10 * i), amount=float(i)) for i in range(9)]
    out = hopping.hop_features(frame(spark, rows)).orderBy("window_end").collect()
    assert [r.txn_count_1h for r in out] == [1, 2, 3, 4, 5, 6, 6, 6, 6]
    assert [r.txn_count_5m for r in out] == [1] * 9
    assert out[8].txn_amount_sum_1h == 3.0 + 4 + 5 + 6 + 7 + 8


def test_projection_fills_defaults(spark):
    hops = spark.createDataFrame(
        [("a", None, None, None, None, None, None, None, None)],
        "account_id string, txn_count_1h bigint, txn_amount_sum_1h double, "
        "txn_amount_max_1h double, txn_count_5m bigint, last_is_online boolean, "
        "last_card_present boolean, last_country_code string, last_event_time timestamp_ntz",
    )
    row = hopping.realtime_rows(hops, T0).first().asDict()
    assert row.pop("account_id") == "a" and row.pop("computed_at") == T0
    assert row.pop("distance_from_home") is None
    assert row == S.REALTIME_DEFAULTS


def test_projection_hourly_velocity(spark):
    rows = [txn(f"e{i}", at=minutes(i)) for i in range(6)]
    hops = hopping.hop_features(frame(spark, rows))
    out = hopping.realtime_rows(hops, T0, "hourly").orderBy("txn_count_1h").collect()
    assert [r.txn_velocity_5m for r in out] == [round(n / 60, 4) for n in range(1, 7)]


def test_the_home_is_the_one_at_the_event(spark):
    def at(day):
        return T0 + timedelta(days=day)

    rows = [
        txn("before", at=at(-1), latitude=10.0, longitude=10.0),
        txn("first", at=at(0), latitude=10.0, longitude=10.0),
        txn("still", at=at(4) - timedelta(microseconds=1), latitude=10.0, longitude=10.0),
        txn("moved", at=at(4), latitude=10.0, longitude=10.0),
        txn("always", account="b", at=at(-9), latitude=0.0, longitude=0.0),
        txn("nobody", account="c", latitude=0.0, longitude=0.0),
    ]
    profiles = spark.createDataFrame(
        [
            ("a", 10.0, 10.0, at(0)), ("a", 0.0, 10.0, at(4)), ("a", -5.0, 10.0, at(4)),
            ("b", 0.0, 0.0, None), ("b", 50.0, 50.0, at(3)),
        ],
        "account_id string, home_latitude double, home_longitude double, updated_at timestamp_ntz",
    )
    got = trailing.distance_from_home(frame(spark, rows), trailing.profile_versions(profiles))
    assert got.columns[-1] == "distance_from_home" and "valid_to" not in got.columns
    km = {r.event_id: r.distance_from_home for r in got.collect()}
    assert km.pop("moved") == pytest.approx(1111.95, abs=0.1)
    assert km == {"before": None, "first": 0.0, "still": 0.0, "always": 0.0, "nobody": None}
