import random
import statistics
from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tests.helpers import batch, frame, same, txn
from tidemark import schemas as S
from tidemark.operators import daily, staging
from tidemark.sources.feature_tables import (
    append_rolling,
    conform_batch,
    new_rolling,
    read_daily,
    write_daily,
)

D = date(2024, 4, 1)
NOW = "2024-04-01 02:00:00"


def _on(event_id, days_before, **over):
    at = datetime.combine(D - timedelta(days=days_before), datetime.min.time())
    return txn(event_id, at=at, **over)


@pytest.fixture(scope="module")
def history(spark):
    rng = random.Random(11)
    rows = []
    for i in range(1500):
        account = "hot" if rng.random() < 0.4 else f"a{rng.randrange(20)}"
        rows.append(
            _on(
                f"e{i}",
                rng.randrange(0, 100),
                account=account,
                amount=round(rng.expovariate(0.02), 2),
                merchant=f"m{rng.randrange(9)}",
                merchant_category=rng.choice(["food", "fuel", "toys"]),
                is_online=rng.random() < 0.3,
            )
        )
    return rows


def test_staging_rules(spark):
    rows = [
        txn("ok", merchant_category="FOOD", transaction_type="PURCHASE", country_code=None),
        txn("negative", amount=-1.0),
        txn("no_amount", amount=None),
        txn("unowned", account=None),
        txn("undated", at=None),
        txn("future", at=datetime(2024, 5, 1)),
        txn("edge", at=datetime(2024, 4, 1, 2, 0, 0), merchant_category=None, is_online=None),
        txn("free", amount=0.0, card_present=None),
    ]
    got = {r.event_id: r for r in staging.clean(frame(spark, rows), NOW).collect()}
    assert set(got) == {"ok", "edge", "free"}
    assert (got["ok"].merchant_category, got["ok"].transaction_type) == ("food", "purchase")
    assert got["ok"].country_code == "US"
    assert got["edge"].merchant_category == "unknown" and got["edge"].is_online is False
    assert got["free"].card_present is True


def test_time_order(spark):
    rows = [_on("c", 1), _on("b", 2), _on("a", 2), _on("d", 0)]
    ordered = staging.in_time_order(frame(spark, rows)).collect()
    assert [r.event_id for r in ordered] == ["a", "b", "c", "d"]


def test_window_edges_are_inclusive(spark):
    rows = [_on(f"e{d}", d, merchant=f"m{d}") for d in (0, 7, 8, 30, 31, 90, 91)]
    row = daily.daily_features(frame(spark, rows), D, NOW).first()
    assert (row.txn_count_7d, row.txn_count_30d) == (2, 4)
    assert (row.distinct_merchants_7d, row.distinct_merchants_30d) == (2, 4)
    assert row.avg_daily_txn_count_30d == pytest.approx(4 / 30)
    assert row.days_since_last_txn == 0.0
    v2 = daily.daily_features_v2(frame(spark, rows), D, NOW).first()
    assert v2.avg_daily_txn_count_30d == pytest.approx(6 / 30)


def test_defaults_when_the_last_month_is_empty(spark):
    row = daily.daily_features(frame(spark, [_on("e", 60, amount=5.0)]), D, NOW).first()
    assert (row.avg_txn_amount_30d, row.txn_count_30d, row.pct_online_txns_30d) == (0.0, 0, 0.0)
    assert row.txn_amount_p99_90d == 5.0 and row.days_since_last_txn == 60.0
    assert daily.daily_features(frame(spark, [_on("e", 120)]), D, NOW).count() == 0


def test_daily_against_brute_force(spark, history):
    got = {r.account_id: r for r in daily.daily_features(frame(spark, history), D, NOW).collect()}
    by_account = {}
    for r in history:
        if (D - r["transaction_date"]).days <= 90:
            by_account.setdefault(r["account_id"], []).append(r)
    assert set(got) == set(by_account)
    for account, rows in by_account.items():
        g = got[account]
        recent = [r for r in rows if (D - r["transaction_date"]).days <= 30]
        assert g.txn_count_30d == len(recent)
        assert g.avg_txn_amount_30d == pytest.approx(statistics.mean(r["amount"] for r in recent))
        assert g.distinct_merchants_30d == len({r["merchant_id"] for r in recent})
        assert g.pct_online_txns_30d == pytest.approx(
            sum(r["is_online"] for r in recent) / len(recent)
        )
        cuts = statistics.quantiles([r["amount"] for r in rows], n=100, method="inclusive")
        assert g.txn_amount_p50_90d == pytest.approx(cuts[49])
        assert g.txn_amount_p95_90d == pytest.approx(cuts[94])
        assert g.txn_amount_p99_90d == pytest.approx(cuts[98])
        kinds = [r["merchant_category"] for r in rows]
        best = min(set(kinds), key=lambda c: (-kinds.count(c), c))
        assert g.most_common_merchant_category == best


def _rounded(df, *names):
    return df.withColumns({n: F.round(n, 8) for n in names})


def test_rewritten_forms_equal_the_literal_ones(spark, history):
    df = frame(spark, history)
    shaky = [
        "avg_txn_amount_30d",
        "pct_online_txns_30d",
        "txn_amount_p50_90d",
        "txn_amount_p95_90d",
        "txn_amount_p99_90d",
    ]
    one = daily.daily_features(df, D, NOW)
    joined = daily.daily_features_joined(df, D, NOW)
    assert same(_rounded(one, *shaky), _rounded(joined, *shaky))
    rolled = daily.rolling_metrics(df, D, NOW)
    union = daily.rolling_metrics_union(df, D, NOW)
    assert same(_rounded(rolled, "metric_value"), _rounded(union, "metric_value"))


def test_quantiles_equal_the_built_in(spark, history):
    base = staging.lookback(frame(spark, history), D)
    built_in = base.groupBy("account_id").agg(
        *[F.round(F.percentile("amount", F.lit(p)), 8).alias(n) for n, p in daily.PERCENTILES.items()]
    )
    ours = _rounded(
        daily.grouped_quantiles(base, ["account_id"], "amount", daily.PERCENTILES),
        *daily.PERCENTILES,
    )
    assert same(built_in, ours)


def test_rolling_has_no_row_for_an_idle_window(spark):
    rows = [_on("e1", 20, amount=4.0), _on("e2", 20, amount=6.0), _on("e3", 80, amount=2.0)]
    got = {
        (r.window_days, r.metric_name): r.metric_value
        for r in daily.rolling_metrics(frame(spark, rows), D, NOW).collect()
    }
    assert got == {
        (30, "avg_amount"): 5.0,
        (30, "txn_count"): 2.0,
        (30, "distinct_merchants"): 1.0,
        (90, "avg_amount"): 4.0,
        (90, "txn_count"): 3.0,
        (90, "distinct_merchants"): 1.0,
    }


def test_bootstrap(spark):
    start = datetime(2024, 1, 13, 8, 0)
    rows = [
        txn(f"e{i:02d}", at=start + timedelta(minutes=i), amount=float(i), merchant=f"m{i % 3}",
            merchant_category="b" if i % 2 else "a", is_online=i % 4 == 0)
        for i in range(12)
    ]
    rt = daily.bootstrap_realtime(frame(spark, rows), NOW).first()
    assert (rt.txn_count_1h, rt.txn_amount_sum_1h, rt.txn_amount_max_1h) == (10, 65.0, 11.0)
    assert rt.txn_velocity_5m == 0.1667 and rt.is_weekend is True and rt.hour_of_day == 8
    bt = daily.bootstrap_batch(frame(spark, rows), NOW).first()
    assert (bt.avg_txn_amount_30d, bt.txn_count_30d, bt.txn_count_7d) == (5.5, 12, 12)
    assert (bt.txn_amount_p50_90d, bt.txn_amount_p95_90d, bt.txn_amount_p99_90d) == (6.0, 11.0, 11.0)
    assert bt.distinct_merchants_30d == 3 and bt.most_common_merchant_category == "a"
    assert bt.avg_daily_txn_count_30d == 0.4 and bt.pct_online_txns_30d == 0.25


def test_top_ten_is_cut_before_the_shuffle(spark):
    plan = daily.bootstrap_realtime(frame(spark, [txn("e")]), NOW)
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in text and "Partial" in text


def test_summary(spark):
    rows = [txn("e1", amount=600.0), txn("e2", amount=100.0), txn("e3", account="b", amount=500.0)]
    row = daily.txn_summary(frame(spark, rows)).first()
    assert (row.num_transactions, row.unique_accounts) == (3, 2)
    assert (row.min_amount, row.max_amount, row.avg_amount) == (100.0, 600.0, 400.0)
    assert row.high_value_transactions == 1 and row.high_value_share == pytest.approx(1 / 3)


def test_daily_table_keeps_other_dates(spark, tmp_path, history):
    path = str(tmp_path / "daily")
    df = frame(spark, history)
    write_daily(daily.daily_features(df, "2024-03-31", NOW), path)
    write_daily(daily.daily_features(df, D, NOW), path)
    first = read_daily(spark, path, D).count()
    write_daily(daily.daily_features(df, D, NOW), path)
    assert read_daily(spark, path, D).count() == first > 0
    table = spark.read.parquet(path)
    assert table.select("computation_date").distinct().count() == 2
    assert daily.latest_features(table).count() == first
    plan = table.where(F.col("computation_date") == F.lit(str(D)).cast("date"))
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(computation_date" in text


def test_conform_drops_rows_that_do_not_fit(spark):
    rows = [
        batch("ok"),
        batch("range", pct_online_txns_30d=1.5),
        batch("null", avg_txn_amount_30d=None),
        batch("kind", most_common_merchant_category=None),
    ]
    assert [r.account_id for r in conform_batch(frame(spark, rows, S.BATCH)).collect()] == ["ok"]
    text = frame(spark, rows, S.BATCH).withColumn("txn_count_30d", F.lit("many"))
    assert conform_batch(text).count() == 0


def test_rolling_append_is_incremental(spark, tmp_path, history):
    path = str(tmp_path / "rolling")
    df = frame(spark, history)
    today = daily.rolling_metrics(df, D, NOW)
    append_rolling(spark, today, path)
    n = spark.read.parquet(path).count()
    append_rolling(spark, today, path)
    assert spark.read.parquet(path).count() == n == today.count()
    append_rolling(spark, daily.rolling_metrics(df, "2024-03-31", NOW), path)
    assert spark.read.parquet(path).select("computation_date").distinct().count() == 2


def test_rolling_strict_forward(spark, history):
    df = frame(spark, history)
    today = daily.rolling_metrics(df, D, NOW)
    empty = spark.createDataFrame([], S.ROLLING)
    assert new_rolling(today, empty, strict_forward=True).count() == today.count()
    assert new_rolling(today, today, strict_forward=True).count() == 0
    older = daily.rolling_metrics(df, "2024-03-31", NOW)
    assert new_rolling(older, today, strict_forward=True).count() == 0
    assert new_rolling(today, older, strict_forward=True).count() == today.count()
