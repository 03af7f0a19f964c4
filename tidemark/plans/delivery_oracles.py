"""SQL for the queries about delivery and stored surfaces, straight from the given tables."""

from __future__ import annotations

from tidemark.operators import registry
from tidemark.plans import delivery_queries as d
from tidemark.plans import oracles as o
from tidemark.plans import queries as q
from tidemark.sources import tables

_EARLY = f"event_timestamp < TIMESTAMP '{q.HALFWAY}'"


def _null(column: str, every: int) -> str:
    return f"CASE WHEN event_number % 2 = 0 AND event_number % {every} = 0 THEN '{column}' END"


def sql(plain: dict[str, str]) -> dict[str, str]:
    staged = o._with(o.TXNS, o._staged(q.NOW))
    errors = f"""concat_ws(', ',
    CASE WHEN amount IS NULL OR amount < 0 THEN 'amount' END,
    {_null("merchant_category", 13)},
    CASE WHEN transaction_type NOT IN ('purchase', 'withdrawal', 'transfer', 'payment', 'refund')
      THEN 'transaction_type' END,
    {_null("is_online", 11)}, {_null("card_present", 17)}, {_null("country_code", 19)})"""
    report = ", ".join(
        f"('{name}', '{kind}', {actual}, '{status}')"
        for name, kind, actual, status in _report_rows()
    )
    newest = """newest AS (
  SELECT * FROM hops
  QUALIFY row_number() OVER (PARTITION BY account_id ORDER BY window_end DESC) = 1
)"""
    versions = f"""versions AS (
  SELECT account_id, home_latitude, home_longitude, TIMESTAMP '2024-01-02 00:00:00' AS since,
    CASE WHEN moves THEN TIMESTAMP '{tables.MOVED_AT}' END AS until
  FROM (SELECT *, CAST(substr(account_id, 6) AS BIGINT) % 3 = 0 AS moves FROM profiles)
  UNION ALL
  SELECT account_id, -home_latitude, home_longitude / 2, TIMESTAMP '{tables.MOVED_AT}', NULL
  FROM profiles WHERE CAST(substr(account_id, 6) AS BIGINT) % 3 = 0
)"""
    homes = (
        o._with(o.TXNS, o.PROFILES, o._staged(q.NOW), versions)
        + """SELECT event_id, account_id, round(2 * 6371.0 * atan2(sqrt(h), sqrt(1 - h)), 2)
  AS distance_from_home
FROM (
  SELECT event_id, s.account_id,
    pow(sin(radians(home_latitude - latitude) / 2), 2)
      + cos(radians(latitude)) * cos(radians(home_latitude))
      * pow(sin(radians(home_longitude - longitude) / 2), 2) AS h
  FROM staged s LEFT JOIN versions v ON v.account_id = s.account_id AND s.event_timestamp >= v.since
    AND (v.until IS NULL OR s.event_timestamp < v.until))"""
    )
    latest = o._with(
        o.TXNS, o._staged(q.NOW), o._daily(d.EARLIER_DATES[-1], q.NOW)
    )
    return {
        "q_replayed_once": o._with(o.TXNS, o.CHECKED)
        + """SELECT event_id, account_id, event_timestamp, amount, 'first' AS stream
FROM checked WHERE errors = ''""",
        "q_stream_progress": staged
        + f"""SELECT CAST(count(*) AS BIGINT) AS delivered,
  count(*) FILTER (WHERE {_EARLY}) AS late, count(*) FILTER (WHERE NOT {_EARLY}) AS accepted,
  true AS complete FROM staged""",
        "q_explicit_nulls": o._with(o.TXNS)
        + f"""SELECT event_id, errors, CASE WHEN errors = '' THEN
    coalesce(merchant_category, 'unknown') END AS merchant_category
FROM (SELECT *, {errors} AS errors FROM txns)""",
        "q_snapshot_failure": o._with(o.TXNS, o._staged(q.NOW), o.HOPS, newest)
        + """SELECT account_id, txn_count_1h, txn_amount_sum_1h, true AS failed,
  count(*) OVER () AS features_written FROM newest""",
        "q_schema_report": f"""SELECT * FROM (VALUES {report}) AS t(name, expected, actual, status)""",
        "q_message_cap": """SELECT count(*) > 0 AS whole_batches, count(*) > 0 AS cap_reached,
  count(*) > 0 AS all_taken_are_stored FROM events""",
        "q_home_versions": homes,
        "q_stream_home_versions": homes,
        "q_sql_latest": latest + "SELECT * FROM daily",
        "q_sql_as_of": plain["q_asof_features"],
        "q_sql_history": o._with(
            o.TXNS, o._staged(q.NOW), o.HOPS, o.SNAPS, o._daily(d.EARLIER_DATES[-1], q.NOW)
        )
        + f"""SELECT * FROM snaps
WHERE computed_at BETWEEN TIMESTAMP '{q.HISTORY_RANGE[0]}' AND TIMESTAMP '{q.HISTORY_RANGE[1]}'
  AND account_id = (SELECT account_id FROM daily ORDER BY txn_count_30d DESC, account_id LIMIT 1)""",
        "q_sql_served": plain["q_serving_live"],
        "q_stored_vector": plain["q_model_input"],
    }


def _report_rows() -> list[tuple[str, str, str, str]]:
    """The registry's own entries, with the two that the query breaks."""
    carried = {"int": "bigint", "float": "double", "bool": "boolean", "str": "string"}
    rows = []
    for name, _, kind, _, _ in registry._entries(False):
        actual, status = f"'{carried[kind]}'", "ok"
        if name == "hour_of_day":
            actual = "'int'"
        if name == "txn_count_30d":
            actual, status = "CAST(NULL AS VARCHAR)", "missing"
        if name == "is_new_merchant":
            actual, status = "'string'", "type"
        rows.append((name, kind, actual, status))
    return rows
