import random
from datetime import timedelta

import pytest
from pyspark.sql import functions as F

from tests.helpers import T0, frame, same, txn
from tidemark.functions.clock import MICROS
from tidemark.operators import trailing
from tidemark.operators.pane_frames import counts_by_pane

KEEP = ["event_id", "account_id", "event_timestamp"]


@pytest.fixture(scope="module")
def rows():
    made = random.Random(11)
    out = []
    for i in range(400):
        account = "hot" if i % 3 == 0 else made.choice("abc")
        # Whole seconds and pane edges come often, as do equal times.
        at = T0 + timedelta(seconds=made.choice([10, 300, 3600, 1]) * made.randint(-40, 40))
        out.append(txn(f"e{i}", account=account, at=at, amount=float(made.randint(0, 500))))
    return out


@pytest.mark.parametrize("seconds", [1, 10, 300])
def test_panes_of_any_length_count_as_the_one_shuffle_form_does(spark, rows, seconds):
    df = frame(spark, rows)
    assert same(counts_by_pane(df, KEEP, seconds * MICROS), trailing.trailing_counts(df, KEEP))


def test_frames_equal_brute_force(spark, rows):
    got = {r.event_id: r for r in counts_by_pane(frame(spark, rows), KEEP).collect()}
    for r in rows:
        t = r["event_timestamp"]
        seen = [
            o
            for o in rows
            if o["account_id"] == r["account_id"]
            and t - timedelta(hours=1) <= o["event_timestamp"] <= t
        ]
        g = got[r["event_id"]]
        assert g.txn_count_1h == len(seen)
        assert g.txn_amount_sum_1h == sum(o["amount"] for o in seen)
        assert g.txn_amount_max_1h == max(o["amount"] for o in seen)
        assert g.txn_count_5m == sum(o["event_timestamp"] >= t - timedelta(minutes=5) for o in seen)


def test_one_account_in_one_hour_makes_many_groups(spark):
    rows = [txn(f"e{i}", at=T0 + timedelta(seconds=9 * i)) for i in range(400)]
    counted = counts_by_pane(frame(spark, rows), KEEP)
    assert counted.select(F.spark_partition_id()).distinct().count() > 1
    assert counted.agg(F.max("txn_count_1h")).first()[0] == 400


def test_a_pane_has_to_divide_five_minutes(spark):
    with pytest.raises(ValueError):
        counts_by_pane(frame(spark, [txn("e")]), KEEP, 7 * MICROS)


def test_no_rows(spark):
    assert counts_by_pane(frame(spark, []), KEEP).count() == 0
