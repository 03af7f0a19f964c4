"""SQL for the queries over stored tables: what readers should see, straight from the given tables."""

from __future__ import annotations

from datetime import date

from tidemark.plans import delivery_oracles
from tidemark.plans import oracles as o
from tidemark.plans import queries as q
from tidemark.plans import stored_queries as s

_EARLY = f"event_timestamp < TIMESTAMP '{q.HALFWAY}'"


def _log(early: int, late: int, factor: int) -> str:
    return f"""SELECT account_id, event_id,
  CASE WHEN {_EARLY} THEN amount ELSE amount * {factor} END AS amount,
  CAST(CASE WHEN {_EARLY} THEN {early} ELSE {late} END AS BIGINT) AS batch_id FROM staged"""


def _delta() -> str:
    """Every date from its whole look-back; rolling metrics side by side."""
    ctes, rows = [o.HISTORY, o._history_staged(q.HISTORY_NOW)], []
    for i, at in enumerate(s.DELTA_DATES):
        ctes.append(o._daily(at, f"{at} 23:59:59", name=f"daily{i}"))
        ctes.append(f"rolling{i} AS ({o._rolling(at, q.NOW)})")
        columns = ", ".join(
            f"max(metric_value) FILTER (WHERE metric_name = '{m}' AND window_days = {w}) AS {m}_{w}"
            for w in (7, 30, 90)
            for m in ("avg_amount", "txn_count", "distinct_merchants")
        )
        rows.append(
            f"""SELECT * FROM daily{i} LEFT JOIN (
  SELECT account_id, {columns} FROM rolling{i} GROUP BY account_id) USING (account_id)"""
        )
    return o._with(*ctes) + "\nUNION ALL\n".join(rows)


def sql() -> dict[str, str]:
    plain = o.sql()
    staged = o._with(o.TXNS, o._staged(q.NOW))
    nightly = o._with(
        o.TXNS,
        o._staged(q.NIGHTLY_AT, "staged_nightly"),
        o._daily(q.SERVE_DATE, q.NIGHTLY_AT, src="staged_nightly"),
    )
    live = f"""SELECT * EXCLUDE (computation_date), TIMESTAMP '{q.NIGHTLY_AT}' AS written_at,
  TIMESTAMP '{q.NIGHTLY_AT}' + INTERVAL 129600 SECOND AS expires_at FROM daily"""
    two_dates = o._with(
        o.TXNS,
        o._staged(q.NIGHTLY_AT, "staged_nightly"),
        o._daily(q.SERVE_DATE, q.NIGHTLY_AT, name="newer", src="staged_nightly"),
        o._staged(s.EARLIER_AT, "staged_earlier"),
        o._daily(s.EARLIER_DATE, s.EARLIER_AT, name="older", src="staged_earlier"),
        f"""live AS (
  SELECT * EXCLUDE (computation_date, written_at), written_at,
    written_at + INTERVAL 129600 SECOND AS expires_at
  FROM (SELECT *, TIMESTAMP '{q.NIGHTLY_AT}' AS written_at FROM newer
    UNION ALL SELECT *, TIMESTAMP '{s.EARLIER_AT}' AS written_at FROM older
      WHERE account_id NOT IN (SELECT account_id FROM newer))
  WHERE written_at + INTERVAL 129600 SECOND > TIMESTAMP '{q.SERVE_AT}'
)""",
    )
    out = {
        "q_log_replay": staged + _log(0, 1, 2),
        "q_log_backfill_after_compaction": staged + _log(5, 10, 2),
        "q_log_new_checkpoint": staged + _log(0, 0, 1),
        "q_compacted_serving": two_dates + "SELECT * FROM live",
        "q_deleted_serving": two_dates
        + """SELECT account_id, written_at, expires_at FROM live
WHERE account_id NOT IN (
  SELECT concat('acct_', CAST(c_custkey AS VARCHAR)) FROM customer WHERE c_acctbal < 0)""",
        "q_serving_json": nightly + "SELECT * EXCLUDE (computation_date) FROM daily",
        "q_nightly_daily": nightly + "SELECT * FROM daily",
        "q_nightly_rolling": o._with(o.TXNS, o._staged(q.NIGHTLY_AT))
        + o._rolling(q.SERVE_DATE, q.NIGHTLY_AT),
        "q_nightly_snapshot": nightly
        + f"""SELECT * EXCLUDE (computation_date), TIMESTAMP '{q.NIGHTLY_AT}' AS committed_at,
  epoch_us(TIMESTAMP '{q.NIGHTLY_AT}') AS snapshot_id,
  CAST({date.fromisoformat(q.SERVE_DATE).toordinal()} AS BIGINT) AS batch_id FROM daily""",
        "q_nightly_served": nightly + live,
        "q_nightly_delta": _delta(),
        "q_snapshots_after_expiry": o._with(o.TXNS, o._staged(q.NOW), o.HOPS, o.SNAPS)
        + f"""SELECT * FROM snaps WHERE NOT (
  committed_at < TIMESTAMP '{q.NOW}' - INTERVAL 30 DAY
  AND snapshot_id NOT IN (SELECT DISTINCT snapshot_id FROM snaps ORDER BY 1 DESC LIMIT 10))""",
        "q_asof_lookback": f"""SELECT account_id, as_of, event_id,
  CASE WHEN recent THEN computed_at END AS computed_at,
  CASE WHEN recent THEN snapshot_id END AS snapshot_id
FROM (SELECT *, as_of >= TIMESTAMP '{q.NOW}' - INTERVAL {s.LOOKBACK_DAYS} DAY AS recent
  FROM ({plain["q_asof_training_set"]}))""",
        "q_time_order": staged + "SELECT event_id, event_timestamp FROM staged",
        "q_event_lines": plain["q_valid_events"],
        "q_retry_dead_letter": f"""SELECT event_id AS offset,
  CASE WHEN event_id = {s.FAILING} THEN 'failed' ELSE 'processed' END AS outcome FROM events""",
        "q_stream_updates": plain["q_hop_1h"],
        "q_stream_dedup": plain["q_hop_1h"],
        "q_late_rows": o._with(
            o.TXNS,
            o._staged(q.NOW, "everything"),
            f"staged AS (SELECT * FROM everything WHERE NOT ({_EARLY}))",
            o.HOPS,
        )
        + "SELECT * FROM hops",
    }
    return {**plain, **out, **delivery_oracles.sql(plain)}
