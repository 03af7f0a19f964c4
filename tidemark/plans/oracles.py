"""Independent SQL for the registered queries, written against the given tables.

The SQL takes the plain road on purpose: self-joins for trailing windows, one aggregate per window,
ordered quantiles and joins, none of the slices, panes, cells or running maxima the Spark side uses.
"""

from __future__ import annotations

from tidemark.plans import queries as q

_REALTIME = [
    "txn_count_1h",
    "txn_amount_sum_1h",
    "txn_amount_max_1h",
    "txn_velocity_5m",
    "distance_from_home",
    "is_new_merchant",
    "hour_of_day",
    "is_weekend",
    "is_online",
    "card_present",
    "country_code",
]
_BATCH = [
    "avg_txn_amount_30d",
    "txn_count_30d",
    "distinct_merchants_30d",
    "distinct_merchants_7d",
    "txn_count_7d",
    "txn_amount_p50_90d",
    "txn_amount_p95_90d",
    "txn_amount_p99_90d",
    "days_since_last_txn",
    "avg_daily_txn_count_30d",
    "most_common_merchant_category",
    "pct_online_txns_30d",
]
_EIGHT = {
    "avg_txn_amount_30d",
    "txn_amount_p50_90d",
    "txn_amount_p95_90d",
    "txn_amount_p99_90d",
    "avg_daily_txn_count_30d",
    "pct_online_txns_30d",
}

TXNS = """txns AS (
  SELECT
    concat('evt_', CAST(event_id AS VARCHAR)) AS event_id,
    event_id AS event_number,
    concat('acct_', CAST(user_id AS VARCHAR)) AS account_id,
    ts AS event_timestamp,
    CAST(ts AS DATE) AS transaction_date,
    value AS amount,
    concat('merch_', regexp_extract(props, '[0-9]+', 0)) AS merchant_id,
    CASE WHEN event_id % 13 = 0 THEN NULL ELSE upper(event_type) END AS merchant_category,
    CASE event_type WHEN 'purchase' THEN 'purchase' WHEN 'click' THEN 'payment'
      WHEN 'view' THEN 'transfer' WHEN 'signup' THEN 'withdrawal' ELSE 'error' END
      AS transaction_type,
    CASE WHEN event_id % 10 = 0 THEN NULL
      ELSE CAST((event_id * 7919) % 18001 AS DOUBLE) / 100.0 - 90.0 END AS latitude,
    CASE WHEN event_id % 10 = 0 THEN NULL
      ELSE CAST((event_id * 104729) % 36001 AS DOUBLE) / 100.0 - 180.0 END AS longitude,
    CASE WHEN event_id % 11 = 0 THEN NULL ELSE event_id % 3 = 0 END AS is_online,
    CASE WHEN event_id % 17 = 0 THEN NULL ELSE event_id % 3 <> 0 END AS card_present,
    CASE WHEN event_id % 19 = 0 THEN NULL WHEN event_id % 7 = 0 THEN 'CA' ELSE 'US' END
      AS country_code,
    ts AS ingested_at
  FROM events
)"""

HISTORY = """txns AS (
  SELECT
    concat('acct_', CAST(o_custkey AS VARCHAR)) AS account_id,
    o_orderdate AS event_timestamp,
    CAST(o_orderdate AS DATE) AS transaction_date,
    l_extendedprice AS amount,
    concat('merch_', CAST(l_suppkey AS VARCHAR)) AS merchant_id,
    l_returnflag AS merchant_category,
    l_linestatus = 'O' AS is_online
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey
)"""

PROFILES = """profiles AS (
  SELECT
    concat('acct_', CAST(c_custkey AS VARCHAR)) AS account_id,
    CASE WHEN c_custkey % 9 = 0 THEN NULL
      ELSE CAST((c_custkey * 31) % 18001 AS DOUBLE) / 100.0 - 90.0 END AS home_latitude,
    CASE WHEN c_custkey % 9 = 0 THEN NULL
      ELSE CAST((c_custkey * 37) % 36001 AS DOUBLE) / 100.0 - 180.0 END AS home_longitude
  FROM customer
)"""


def _staged(now: str, name: str = "staged") -> str:
    return f"""{name} AS (
  SELECT * REPLACE (
    coalesce(lower(merchant_category), 'unknown') AS merchant_category,
    lower(transaction_type) AS transaction_type,
    coalesce(is_online, false) AS is_online,
    coalesce(card_present, true) AS card_present,
    coalesce(country_code, 'US') AS country_code)
  FROM txns
  WHERE amount >= 0 AND account_id IS NOT NULL AND event_timestamp IS NOT NULL
    AND event_timestamp <= TIMESTAMP '{now}'
)"""


def _history_staged(now: str) -> str:
    return f"""staged AS (
  SELECT * REPLACE (coalesce(lower(merchant_category), 'unknown') AS merchant_category)
  FROM txns WHERE amount >= 0 AND event_timestamp <= TIMESTAMP '{now}'
)"""


def _with(*ctes: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n"


# Strict validation.
CHECKED = """checked AS (
  SELECT *, concat_ws(', ',
    CASE WHEN event_id IS NULL THEN 'event_id' END,
    CASE WHEN account_id IS NULL THEN 'account_id' END,
    CASE WHEN event_timestamp IS NULL THEN 'timestamp' END,
    CASE WHEN amount IS NULL OR amount < 0 THEN 'amount' END,
    CASE WHEN merchant_id IS NULL THEN 'merchant_id' END,
    CASE WHEN transaction_type IS NULL OR transaction_type NOT IN
      ('purchase', 'withdrawal', 'transfer', 'payment', 'refund') THEN 'transaction_type' END,
    CASE WHEN abs(latitude) > 90 THEN 'latitude' END,
    CASE WHEN abs(longitude) > 180 THEN 'longitude' END,
    CASE WHEN length(country_code) > 3 THEN 'country_code' END) AS errors
  FROM txns
)"""
_REFUSED = f"event_number % {q.REFUSED_EVERY} = {q.REFUSED_AT}"
ROUTE = "CAST(CAST('0x' || substr(md5(account_id), 1, 8) AS BIGINT) % 8 AS INTEGER)"

_MESSAGE_FIELDS = """event_id, account_id, event_timestamp, amount, merchant_id, merchant_category,
  transaction_type, latitude, longitude, is_online, card_present, country_code"""

# Trailing windows by self-join.
TRAILING = """windowed AS (
  SELECT a.event_id,
    count(*) AS txn_count_1h,
    round(sum(b.amount), 2) AS txn_amount_sum_1h,
    round(max(b.amount), 2) AS txn_amount_max_1h,
    count(*) FILTER (WHERE b.event_timestamp >= a.event_timestamp - INTERVAL 5 MINUTE)
      AS txn_count_5m
  FROM staged a JOIN staged b ON a.account_id = b.account_id
    AND b.event_timestamp <= a.event_timestamp
    AND b.event_timestamp >= a.event_timestamp - INTERVAL 1 HOUR
  GROUP BY a.event_id
)"""
NOVELTY = """novelty AS (
  SELECT event_id, row_number() OVER (
    PARTITION BY account_id, merchant_id ORDER BY event_timestamp, event_id) = 1 AS is_new_merchant
  FROM staged
)"""
DISTANCE = """distance AS (
  SELECT event_id, round(2 * 6371.0 * atan2(sqrt(h), sqrt(1 - h)), 2) AS distance_from_home
  FROM (
    SELECT event_id,
      pow(sin(radians(home_latitude - latitude) / 2), 2)
        + cos(radians(latitude)) * cos(radians(home_latitude))
        * pow(sin(radians(home_longitude - longitude) / 2), 2) AS h
    FROM staged LEFT JOIN profiles USING (account_id))
)"""
_VELOCITY = "round(CASE WHEN {n} = 0 THEN 0.0 ELSE {n} / least(5.0, {n}) END, 4)"
_CLOCK = """CAST(hour({ts}) AS INTEGER) AS hour_of_day, isodow({ts}) >= 6 AS is_weekend"""

# The sliding window as a self-join of pane ends and events.
HOPS = """panes AS (
  SELECT DISTINCT account_id,
    make_timestamp(CAST((floor(epoch_us(event_timestamp) / 10000000) + 1) * 10000000 AS BIGINT))
      AS window_end
  FROM staged
),
totals AS (
  SELECT p.account_id, p.window_end,
    count(*) AS txn_count_1h,
    round(sum(s.amount), 2) AS txn_amount_sum_1h,
    round(max(s.amount), 2) AS txn_amount_max_1h,
    count(*) FILTER (WHERE s.event_timestamp >= p.window_end - INTERVAL 5 MINUTE) AS txn_count_5m
  FROM panes p JOIN staged s ON s.account_id = p.account_id
    AND s.event_timestamp >= p.window_end - INTERVAL 1 HOUR
    AND s.event_timestamp < p.window_end
  GROUP BY p.account_id, p.window_end
),
lasts AS (
  SELECT p.account_id, p.window_end, s.merchant_id, s.latitude, s.longitude, s.is_online,
    s.card_present, s.country_code, s.event_timestamp,
    row_number() OVER (PARTITION BY p.account_id, p.window_end
      ORDER BY s.event_timestamp DESC, s.event_id DESC) AS rn
  FROM panes p JOIN staged s ON s.account_id = p.account_id
    AND s.event_timestamp >= p.window_end - INTERVAL 1 HOUR
    AND s.event_timestamp < p.window_end
),
hops AS (
  SELECT t.account_id, t.txn_count_1h, t.txn_amount_sum_1h, t.txn_amount_max_1h, t.txn_count_5m,
    merchant_id AS last_merchant_id, latitude AS last_latitude, longitude AS last_longitude,
    is_online AS last_is_online, card_present AS last_card_present,
    country_code AS last_country_code, event_timestamp AS last_event_time, t.window_end
  FROM totals t JOIN lasts USING (account_id, window_end) WHERE rn = 1
)"""


def _projection(computed_at: str, velocity: str) -> str:
    return f"""account_id, {computed_at} AS computed_at, txn_count_1h, txn_amount_sum_1h,
  txn_amount_max_1h, {velocity} AS txn_velocity_5m, CAST(NULL AS DOUBLE) AS distance_from_home,
  false AS is_new_merchant, {_CLOCK.format(ts="last_event_time")},
  last_is_online AS is_online, last_card_present AS card_present,
  last_country_code AS country_code"""


SNAPS = f"""snaps AS (
  SELECT {_projection("last_event_time", _VELOCITY.format(n="txn_count_5m"))},
    window_end AS committed_at, epoch_us(window_end) AS snapshot_id
  FROM hops
)"""


def _daily(date: str, now: str, variant: bool = False, name: str = "daily", src: str = "staged") -> str:
    """Four aggregates per account, outer-joined on the account."""
    span = "base" if variant else "d30"
    return f"""{name}_base AS (
  SELECT * FROM {src}
  WHERE transaction_date BETWEEN DATE '{date}' - 90 AND DATE '{date}'
),
{name}_30 AS (
  SELECT account_id, avg(amount) AS avg_amount, count(*) AS n,
    count(DISTINCT merchant_id) AS merchants,
    avg(CASE WHEN is_online THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END) AS online
  FROM {name}_base WHERE transaction_date >= DATE '{date}' - 30 GROUP BY account_id
),
{name}_7 AS (
  SELECT account_id, count(DISTINCT merchant_id) AS merchants, count(*) AS n
  FROM {name}_base WHERE transaction_date >= DATE '{date}' - 7 GROUP BY account_id
),
{name}_90 AS (
  SELECT account_id, count(*) AS n,
    avg(CASE WHEN is_online THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END) AS online,
    quantile_cont(amount, 0.50) AS p50, quantile_cont(amount, 0.95) AS p95,
    quantile_cont(amount, 0.99) AS p99,
    CAST(date_diff('day', max(transaction_date), DATE '{date}') AS DOUBLE) AS idle
  FROM {name}_base GROUP BY account_id
),
{name}_mode AS (
  SELECT account_id, merchant_category FROM (
    SELECT account_id, merchant_category, row_number() OVER (
      PARTITION BY account_id ORDER BY count(*) DESC, merchant_category) AS rn
    FROM {name}_base GROUP BY account_id, merchant_category) WHERE rn = 1
),
{name} AS (
  SELECT account_id, DATE '{date}' AS computation_date, TIMESTAMP '{now}' AS computed_at,
    round(coalesce(d30.avg_amount, 0), 8) AS avg_txn_amount_30d,
    coalesce(d30.n, 0) AS txn_count_30d,
    coalesce(d30.merchants, 0) AS distinct_merchants_30d,
    coalesce(d7.merchants, 0) AS distinct_merchants_7d,
    coalesce(d7.n, 0) AS txn_count_7d,
    round(coalesce(base.p50, 0), 8) AS txn_amount_p50_90d,
    round(coalesce(base.p95, 0), 8) AS txn_amount_p95_90d,
    round(coalesce(base.p99, 0), 8) AS txn_amount_p99_90d,
    coalesce(base.idle, 0) AS days_since_last_txn,
    round(coalesce({span}.n, 0) / 30.0::DOUBLE, 8) AS avg_daily_txn_count_30d,
    coalesce(m.merchant_category, 'unknown') AS most_common_merchant_category,
    round(coalesce({span}.online, 0), 8) AS pct_online_txns_30d
  FROM {name}_30 d30 FULL OUTER JOIN {name}_7 d7 USING (account_id)
    FULL OUTER JOIN {name}_90 base USING (account_id)
    FULL OUTER JOIN {name}_mode m USING (account_id)
)"""


def _rolling(date: str, now: str, windows: tuple[int, ...] = (7, 30, 90)) -> str:
    branches = []
    for w in windows:
        for metric, value in (
            ("avg_amount", "avg(amount)"),
            ("txn_count", "CAST(count(*) AS DOUBLE)"),
            ("distinct_merchants", "CAST(count(DISTINCT merchant_id) AS DOUBLE)"),
        ):
            branches.append(
                f"""SELECT account_id, DATE '{date}' AS computation_date,
  CAST({w} AS INTEGER) AS window_days, '{metric}' AS metric_name,
  round(coalesce({value}, 0), 8) AS metric_value, TIMESTAMP '{now}' AS computed_at
FROM staged WHERE transaction_date BETWEEN DATE '{date}' - {w} AND DATE '{date}'
GROUP BY account_id"""
            )
    return "\nUNION ALL\n".join(branches)


# Serving rows at SERVE_AT.
_SERVED = [
    TXNS,
    _staged(q.SERVE_AT),
    HOPS,
    f"""live_rt AS (
  SELECT * FROM (SELECT *, row_number() OVER (
      PARTITION BY account_id ORDER BY written_at DESC) AS rn
    FROM (SELECT *, window_end AS written_at, window_end + INTERVAL 3600 SECOND AS expires_at FROM (
      SELECT {_projection("last_event_time", _VELOCITY.format(n="txn_count_5m"))}, window_end
      FROM hops))
    WHERE written_at <= TIMESTAMP '{q.SERVE_AT}')
  WHERE rn = 1 AND expires_at > TIMESTAMP '{q.SERVE_AT}'
)""",
    _staged(q.NIGHTLY_AT, "staged_nightly"),
    _daily(q.SERVE_DATE, q.NIGHTLY_AT, src="staged_nightly"),
    f"""live_bt AS (
  SELECT *, TIMESTAMP '{q.NIGHTLY_AT}' AS written_at,
    TIMESTAMP '{q.NIGHTLY_AT}' + INTERVAL 129600 SECOND AS expires_at
  FROM daily
)""",
]

_RT_DEFAULTS = {
    "txn_count_1h": "0",
    "txn_amount_sum_1h": "0.0",
    "txn_amount_max_1h": "0.0",
    "txn_velocity_5m": "0.0",
    "is_new_merchant": "false",
    "hour_of_day": "0",
    "is_weekend": "false",
    "is_online": "false",
    "card_present": "true",
    "country_code": "'US'",
}


def _vector_columns(rt_prefix: str = "", bt_prefix: str = "") -> str:
    parts = []
    for n in _REALTIME:
        value = f"coalesce(r.{n}, {_RT_DEFAULTS[n]})" if n in _RT_DEFAULTS else f"r.{n}"
        parts.append(f"{value} AS {rt_prefix}{n}")
    for n in _BATCH:
        default = "'unknown'" if n == "most_common_merchant_category" else "0"
        parts.append(f"coalesce(b.{n}, {default}) AS {bt_prefix}{n}")
    return ",\n  ".join(parts)


def _diff() -> str:
    def text(alias: str, n: str) -> str:
        return f"CAST({alias}.{n} AS VARCHAR)"

    branches = []
    for n in _REALTIME:
        if n == "country_code":
            delta = "CAST(NULL AS DOUBLE)"
        elif n.startswith("is_") or n == "card_present":
            delta = f"CAST(CAST(b.{n} AS INTEGER) - CAST(a.{n} AS INTEGER) AS DOUBLE)"
        else:
            delta = f"round(CAST(b.{n} AS DOUBLE) - CAST(a.{n} AS DOUBLE), 8)"
        branches.append(
            f"""SELECT a.account_id, TIMESTAMP '{q.PAIR[0]}' AS timestamp_a,
  TIMESTAMP '{q.PAIR[1]}' AS timestamp_b, '{n}' AS feature, {text("a", n)} AS "before",
  {text("b", n)} AS "after", {delta} AS delta
FROM at_a a JOIN at_b b USING (account_id) WHERE a.{n} IS DISTINCT FROM b.{n}"""
        )
    return "\nUNION ALL\n".join(branches)


def _at(name: str, moment: str) -> str:
    return f"""{name} AS (
  SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (
    PARTITION BY account_id ORDER BY computed_at DESC, snapshot_id DESC) AS rn
  FROM snaps WHERE committed_at <= TIMESTAMP '{moment}') WHERE rn = 1
)"""


def _profile() -> str:
    listed = [
        ("avg_txn_amount_30d", "30d"),
        ("txn_count_30d", "30d"),
        ("distinct_merchants_7d", "7d"),
        ("distinct_merchants_30d", "30d"),
        ("txn_amount_p95_90d", "90d"),
        ("txn_amount_p99_90d", "90d"),
        ("days_since_last_txn", "point"),
        ("pct_online_txns_30d", "30d"),
    ]
    return "\nUNION ALL\n".join(
        f"""SELECT '{n}' AS feature, 'cold' AS path, '{w}' AS "window",
  count({n}) AS num_accounts, round(CAST(min({n}) AS DOUBLE), 8) AS min_value,
  round(CAST(max({n}) AS DOUBLE), 8) AS max_value FROM input"""
        for n, w in listed
    )


def _skew() -> str:
    def number(alias: str, n: str) -> str:
        inner = f"CAST({alias}.{n} AS INTEGER)" if n == "is_new_merchant" else f"{alias}.{n}"
        return f"CAST({inner} AS DOUBLE)"

    return "\nUNION ALL\n".join(
        f"""SELECT h.account_id, '{n}' AS feature, CAST(h.{n} AS VARCHAR) AS hot_value,
  CAST(c.{n} AS VARCHAR) AS cold_value, round(abs({number("h", n)} - {number("c", n)}), 8) AS gap
FROM hot h JOIN cold c USING (account_id) WHERE abs({number("h", n)} - {number("c", n)}) > 0.005"""
        for n in ("txn_count_1h", "txn_amount_sum_1h", "txn_amount_max_1h", "is_new_merchant")
    )


def sql() -> dict[str, str]:
    staged = _with(TXNS, _staged(q.NOW))
    checked = _with(TXNS, CHECKED)
    snaps = [TXNS, _staged(q.NOW), HOPS, SNAPS]
    served = _with(*_SERVED)
    dead_position = f"""'fraud.transactions.raw' AS source_topic, {ROUTE} AS source_partition,
  event_number AS source_offset"""
    daily_rows = "SELECT * FROM daily"
    out: dict[str, str] = {}

    out["q_decode_messages"] = _with(TXNS) + f"SELECT {_MESSAGE_FIELDS} FROM txns"
    out["q_validate_events"] = (
        checked + "SELECT event_id, account_id, errors, errors = '' AS is_valid FROM checked"
    )
    out["q_valid_events"] = (
        checked
        + """SELECT event_id, account_id, event_timestamp, amount, merchant_id,
  coalesce(merchant_category, 'unknown') AS merchant_category, transaction_type, latitude,
  longitude, coalesce(is_online, false) AS is_online, coalesce(card_present, true) AS card_present,
  coalesce(country_code, 'US') AS country_code
FROM checked WHERE errors = ''"""
    )
    out["q_dead_letter"] = (
        checked
        + f"""SELECT event_id, concat('Validation error: ', errors) AS error_reason,
  {dead_position}, TIMESTAMP '{q.NOW}' AS failed_at
FROM checked WHERE errors <> ''"""
    )
    out["q_redrive"] = (
        checked + "SELECT event_id, account_id, amount, errors FROM checked WHERE errors <> ''"
    )
    out["q_ingest_stats"] = (
        checked
        + f"""SELECT count(*) FILTER (WHERE errors = '' AND NOT {_REFUSED}) AS processed,
  count(*) FILTER (WHERE errors = '' AND {_REFUSED}) AS failed,
  count(*) FILTER (WHERE errors <> '' OR {_REFUSED}) AS dlq_routed FROM checked"""
    )
    out["q_handled_messages"] = (
        checked
        + f"""SELECT event_number AS offset, outcome,
  CAST(CASE outcome WHEN 'failed' THEN 2 WHEN 'dead' THEN 0 ELSE 1 END AS INTEGER) AS attempts,
  CASE WHEN outcome = 'done' THEN account_id END AS account,
  CASE WHEN outcome = 'done' THEN CAST(floor(amount * 100 + 0.5) AS BIGINT) END AS cents
FROM (SELECT *, CASE WHEN errors <> '' THEN 'dead' WHEN {_REFUSED} THEN 'failed' ELSE 'done' END AS outcome
  FROM checked)"""
    )
    out["q_handled_dead_letter"] = (
        checked
        + f"""SELECT event_id, CASE WHEN errors <> '' THEN concat('Validation error: ', errors)
    ELSE 'Max retries exhausted' END AS error_reason, event_number AS source_offset,
  CASE WHEN errors = '' THEN 'LookupError: no ledger for this message' END AS error,
  CASE WHEN errors = '' THEN '2' END AS attempts
FROM checked WHERE errors <> '' OR {_REFUSED}"""
    )
    out["q_dlq_depth"] = (
        checked
        + """SELECT concat('Validation error: ', errors) AS error_reason, count(*) AS depth,
  count(*) > 1000 AS alert FROM checked WHERE errors <> '' GROUP BY errors"""
    )
    out["q_staging"] = staged + "SELECT * EXCLUDE (event_number) FROM staged"
    out["q_event_dedup"] = (
        _with(TXNS) + "SELECT DISTINCT event_id, account_id, event_timestamp, amount FROM txns"
    )
    out["q_publish"] = (
        checked
        + f"""SELECT account_id AS key, {ROUTE} AS partition, event_id, transaction_type
FROM checked WHERE errors = ''"""
    )
    out["q_route_partition"] = (
        _with(TXNS) + f"SELECT event_id, account_id, {ROUTE} AS partition FROM txns"
    )

    out["q_trailing_1h"] = (
        _with(TXNS, _staged(q.NOW), TRAILING)
        + """SELECT event_id, account_id, event_timestamp, txn_count_1h, txn_amount_sum_1h,
  txn_amount_max_1h FROM staged JOIN windowed USING (event_id)"""
    )
    out["q_velocity_5m"] = (
        _with(TXNS, _staged(q.NOW), TRAILING)
        + f"""SELECT event_id, account_id, txn_count_5m,
  {_VELOCITY.format(n="txn_count_5m")} AS txn_velocity_5m,
  round(txn_count_1h / 60.0::DOUBLE, 4) AS velocity_hourly,
  round(txn_count_5m / 5.0::DOUBLE, 4) AS velocity_per_minute
FROM staged JOIN windowed USING (event_id)"""
    )
    out["q_is_new_merchant"] = (
        _with(TXNS, _staged(q.NOW), NOVELTY)
        + """SELECT event_id, account_id, merchant_id, is_new_merchant
FROM staged JOIN novelty USING (event_id)"""
    )
    out["q_distance_from_home"] = (
        _with(TXNS, PROFILES, _staged(q.NOW), DISTANCE)
        + """SELECT event_id, account_id, distance_from_home
FROM staged JOIN distance USING (event_id)"""
    )
    out["q_event_clock"] = (
        staged + f"SELECT event_id, {_CLOCK.format(ts='event_timestamp')} FROM staged"
    )
    out["q_realtime_vector"] = (
        _with(TXNS, PROFILES, _staged(q.NOW), TRAILING, NOVELTY, DISTANCE)
        + f"""SELECT event_id, account_id, event_timestamp AS computed_at, txn_count_1h,
  txn_amount_sum_1h, txn_amount_max_1h, {_VELOCITY.format(n="txn_count_5m")} AS txn_velocity_5m,
  distance_from_home, is_new_merchant, {_CLOCK.format(ts="event_timestamp")}, is_online,
  card_present, country_code
FROM staged JOIN windowed USING (event_id) JOIN novelty USING (event_id)
  JOIN distance USING (event_id)"""
    )
    out["q_last_values"] = (
        staged
        + """SELECT account_id, merchant_id AS last_merchant_id, latitude AS last_latitude,
  longitude AS last_longitude, is_online AS last_is_online, card_present AS last_card_present,
  country_code AS last_country_code, event_timestamp AS last_event_time
FROM (SELECT *, row_number() OVER (
    PARTITION BY account_id ORDER BY event_timestamp DESC, event_id DESC) AS rn FROM staged)
WHERE rn = 1"""
    )
    out["q_hop_1h"] = _with(TXNS, _staged(q.NOW), HOPS) + "SELECT * FROM hops"
    out["q_stream_hop_1h"] = out["q_hop_1h"]
    out["q_stream_valid_events"] = out["q_valid_events"]
    out["q_stream_dead_letter"] = (
        checked
        + f"""SELECT event_id, concat('Validation error: ', errors) AS error_reason,
  {dead_position} FROM checked WHERE errors <> ''"""
    )
    out["q_stream_first_visits"] = (
        _with(TXNS, _staged(q.NOW))
        + "SELECT account_id, merchant_id, event_id FROM staged QUALIFY row_number() OVER "
        "(PARTITION BY account_id, merchant_id ORDER BY event_timestamp, event_id) = 1"
    )
    out["q_stream_new_merchant"] = out["q_is_new_merchant"]
    out["q_stream_served"] = (
        _with(
            TXNS,
            PROFILES,
            _staged(q.NOW),
            HOPS,
            DISTANCE,
            NOVELTY,
            """newest AS (
  SELECT * FROM hops
  QUALIFY row_number() OVER (PARTITION BY account_id ORDER BY window_end DESC) = 1
)""",
            """last_event AS (
  SELECT account_id, event_id FROM staged
  QUALIFY row_number() OVER (
    PARTITION BY account_id ORDER BY event_timestamp DESC, event_id DESC) = 1
)""",
        )
        + f"""SELECT account_id, TIMESTAMP '{q.NOW}' AS computed_at, txn_count_1h,
  txn_amount_sum_1h, txn_amount_max_1h, {_VELOCITY.format(n="txn_count_5m")} AS txn_velocity_5m,
  distance_from_home, is_new_merchant, {_CLOCK.format(ts="last_event_time")},
  last_is_online AS is_online, last_card_present AS card_present,
  last_country_code AS country_code, TIMESTAMP '{q.NOW}' AS written_at,
  TIMESTAMP '{q.NOW}' + INTERVAL 3600 SECOND AS expires_at
FROM newest JOIN last_event USING (account_id) JOIN distance USING (event_id)
  JOIN novelty USING (event_id)"""
    )
    out["q_realtime_projection"] = (
        _with(TXNS, _staged(q.NOW), HOPS)
        + f"""SELECT {_projection(f"TIMESTAMP '{q.NOW}'",
                                  "round(txn_count_1h / 60.0::DOUBLE, 4)")}, window_end FROM hops"""
    )

    daily = _daily(q.TARGET_DATE, q.NOW)
    out["q_daily_features"] = _with(TXNS, _staged(q.NOW), daily) + daily_rows
    out["q_daily_joined"] = out["q_daily_features"]
    out["q_daily_features_v2"] = (
        _with(TXNS, _staged(q.NOW), _daily(q.TARGET_DATE, q.NOW, variant=True))
        + "SELECT * EXCLUDE (computation_date) FROM daily"
    )
    history = _with(
        HISTORY, _history_staged(q.HISTORY_NOW), _daily(q.HISTORY_DATE, q.HISTORY_NOW)
    )
    out["q_history_daily"] = history + daily_rows
    out["q_fetch_daily"] = history + "SELECT * EXCLUDE (computation_date) FROM daily"
    until = f"DATE '{q.HISTORY_DATE}'"
    span = "SELECT {w} AS w, * FROM staged WHERE transaction_date BETWEEN {until} - {w} AND {until}"
    spans = " UNION ALL ".join(span.format(w=w, until=until) for w in (7, 30, 90))
    out["q_sketch_accuracy"] = (
        _with(HISTORY, _history_staged(q.HISTORY_NOW))
        + f"""SELECT account_id, CAST(w AS INTEGER) AS window_days, count(*) AS rows,
  count(DISTINCT merchant_id) AS exact_merchants, true AS merchants_within, true AS p50_within,
  true AS p95_within, true AS p99_within
FROM ({spans}) GROUP BY account_id, w"""
    )
    out["q_sketch_features"] = history + (
        "SELECT * EXCLUDE (distinct_merchants_30d, distinct_merchants_7d, txn_amount_p50_90d, "
        "txn_amount_p95_90d, txn_amount_p99_90d) FROM daily"
    )
    out["q_rolling_metrics"] = staged + _rolling(q.TARGET_DATE, q.NOW)
    out["q_rolling_union"] = out["q_rolling_metrics"]
    out["q_history_rolling"] = _with(HISTORY, _history_staged(q.HISTORY_NOW)) + _rolling(
        q.HISTORY_DATE, q.HISTORY_NOW
    )
    out["q_rolling_incremental"] = staged + _rolling(q.TARGET_DATE, q.NOW, (30, 90))
    out["q_latest_features"] = (
        _with(
            TXNS,
            _staged(q.NOW),
            _daily("2024-01-20", q.NOW, name="older"),
            _daily("2024-01-30", q.NOW, name="newer"),
            "both_days AS (SELECT * FROM older UNION ALL SELECT * FROM newer)",
        )
        + """SELECT * FROM both_days
WHERE computation_date = (SELECT max(computation_date) FROM both_days)"""
    )
    out["q_bootstrap_features"] = (
        staged
        + f""", ranked AS (
  SELECT account_id, amount, count(*) OVER (PARTITION BY account_id) AS n,
    row_number() OVER (PARTITION BY account_id ORDER BY amount) - 1 AS i FROM staged
),
picks AS (
  SELECT account_id,
    max(CASE WHEN i = least(floor(n * 0.50::DOUBLE), n - 1) THEN amount END) AS p50,
    max(CASE WHEN i = least(floor(n * 0.95::DOUBLE), n - 1) THEN amount END) AS p95,
    max(CASE WHEN i = least(floor(n * 0.99::DOUBLE), n - 1) THEN amount END) AS p99
  FROM ranked GROUP BY account_id
),
cats AS (
  SELECT account_id, merchant_category FROM (
    SELECT account_id, merchant_category, row_number() OVER (
      PARTITION BY account_id ORDER BY count(*) DESC, merchant_category) AS rn
    FROM staged GROUP BY account_id, merchant_category) WHERE rn = 1
)
SELECT account_id, TIMESTAMP '{q.NOW}' AS computed_at,
  CAST(round(CAST(avg(amount) AS DECIMAL(28, 8)), 2) AS DOUBLE) AS avg_txn_amount_30d,
  count(*) AS txn_count_30d, count(DISTINCT merchant_id) AS distinct_merchants_30d,
  count(DISTINCT merchant_id) AS distinct_merchants_7d, count(*) AS txn_count_7d,
  round(any_value(p50), 2) AS txn_amount_p50_90d, round(any_value(p95), 2) AS txn_amount_p95_90d,
  round(any_value(p99), 2) AS txn_amount_p99_90d, 0.0::DOUBLE AS days_since_last_txn,
  round(count(*) / 30.0::DOUBLE, 2) AS avg_daily_txn_count_30d,
  any_value(cats.merchant_category) AS most_common_merchant_category,
  CAST(round(CAST(avg(CASE WHEN is_online THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END)
    AS DECIMAL(28, 8)), 2) AS DOUBLE) AS pct_online_txns_30d
FROM staged JOIN picks USING (account_id) JOIN cats USING (account_id)
GROUP BY account_id"""
    )
    out["q_bootstrap_realtime"] = (
        staged
        + f""", recent AS (
  SELECT *, row_number() OVER (
    PARTITION BY account_id ORDER BY event_timestamp DESC, event_id DESC) AS rn FROM staged
),
sums AS (
  SELECT account_id, count(*) AS n, round(sum(amount), 2) AS total, round(max(amount), 2) AS top
  FROM recent WHERE rn <= 10 GROUP BY account_id
)
SELECT account_id, TIMESTAMP '{q.NOW}' AS computed_at, n AS txn_count_1h,
  total AS txn_amount_sum_1h, top AS txn_amount_max_1h,
  round(n / 60.0::DOUBLE, 4) AS txn_velocity_5m, CAST(NULL AS DOUBLE) AS distance_from_home,
  false AS is_new_merchant, {_CLOCK.format(ts="event_timestamp")}, is_online, card_present,
  country_code
FROM sums JOIN recent USING (account_id) WHERE rn = 1"""
    )
    out["q_txn_summary"] = (
        _with(HISTORY)
        + """SELECT count(*) AS num_transactions, count(DISTINCT account_id) AS unique_accounts,
  min(amount) AS min_amount, max(amount) AS max_amount, round(avg(amount), 4) AS avg_amount,
  count(*) FILTER (WHERE amount > 500) AS high_value_transactions,
  round(count(*) FILTER (WHERE amount > 500) / CAST(count(*) AS DOUBLE), 4) AS high_value_share
FROM txns"""
    )

    out["q_asof_features"] = _with(*snaps, _at("at_t", q.ASOF)) + "SELECT * FROM at_t"
    snap_columns = ", ".join(
        f"s.{c}" for c in ["computed_at", *_REALTIME, "committed_at", "snapshot_id"]
    )
    out["q_asof_training_set"] = (
        _with(
            *snaps,
            """requests AS (
  SELECT account_id, event_timestamp - INTERVAL 1 HOUR AS as_of, event_id FROM staged
)""",
            """matched AS (
  SELECT r.event_id, s.snapshot_id, row_number() OVER (
    PARTITION BY r.event_id ORDER BY s.computed_at DESC, s.snapshot_id DESC) AS rn
  FROM requests r JOIN snaps s ON s.account_id = r.account_id AND s.committed_at <= r.as_of
)""",
        )
        + f"""SELECT r.account_id, r.as_of, r.event_id, {snap_columns}
FROM requests r LEFT JOIN matched m ON m.event_id = r.event_id AND m.rn = 1
  LEFT JOIN snaps s ON s.account_id = r.account_id AND s.snapshot_id = m.snapshot_id"""
    )
    out["q_feature_history"] = (
        _with(*snaps)
        + f"""SELECT * FROM snaps WHERE computed_at BETWEEN TIMESTAMP '{q.HISTORY_RANGE[0]}'
  AND TIMESTAMP '{q.HISTORY_RANGE[1]}'"""
    )
    out["q_feature_diff"] = (
        _with(*snaps, _at("at_a", q.PAIR[0]), _at("at_b", q.PAIR[1])) + _diff()
    )
    out["q_snapshots_to_expire"] = (
        _with(
            *snaps,
            """commits AS (
  SELECT snapshot_id, committed_at, count(*) AS num_rows, row_number() OVER (
    ORDER BY committed_at DESC, snapshot_id DESC) AS age_rank
  FROM snaps GROUP BY snapshot_id, committed_at
)""",
        )
        + f"""SELECT snapshot_id, committed_at, num_rows FROM commits
WHERE committed_at < TIMESTAMP '{q.NOW}' - INTERVAL 30 DAY AND age_rank > 10"""
    )

    out["q_serving_live"] = served + "SELECT * EXCLUDE (rn, window_end) FROM live_rt"
    out["q_feature_vector"] = (
        served
        + f"""SELECT account_id, coalesce(r.computed_at, TIMESTAMP '{q.SERVE_AT}') AS rt_computed_at,
  coalesce(b.computed_at, TIMESTAMP '{q.SERVE_AT}') AS bt_computed_at,
  {_vector_columns("rt_", "bt_")},
  TIMESTAMP '{q.SERVE_AT}' AS served_at, '1.0.0' AS feature_store_version
FROM live_rt r FULL OUTER JOIN live_bt b USING (account_id)"""
    )
    model_input = f"""SELECT {_vector_columns()}, account_id
FROM live_rt r FULL OUTER JOIN live_bt b USING (account_id)"""
    out["q_model_input"] = served + model_input
    out["q_features_by_tag"] = (
        served
        + f"""SELECT account_id, txn_count_1h, txn_velocity_5m, distance_from_home,
  is_new_merchant, txn_amount_p95_90d FROM ({model_input})"""
    )
    out["q_features_by_path"] = served + f", input AS ({model_input})\n" + _profile()
    out["q_delete_account"] = (
        served
        + """SELECT account_id, feature_group, written_at, expires_at FROM (
  SELECT account_id, 'realtime' AS feature_group, written_at, expires_at FROM live_rt
  UNION ALL
  SELECT account_id, 'batch' AS feature_group, written_at, expires_at FROM live_bt)
WHERE account_id NOT IN (
  SELECT concat('acct_', CAST(c_custkey AS VARCHAR)) FROM customer WHERE c_acctbal < 0)"""
    )
    out["q_serving_keys"] = (
        _with(PROFILES)
        + """SELECT account_id, concat('fraud:features:', account_id, ':realtime') AS key
FROM profiles UNION ALL
SELECT account_id, concat('fraud:features:', account_id, ':batch') AS key FROM profiles"""
    )

    out["q_quality_gate"] = (
        _with(
            TXNS,
            _staged(q.NOW),
            _staged(q.NIGHTLY_AT, "staged_nightly"),
            _daily(q.TARGET_DATE, q.NOW, name="features"),
            _daily(q.SERVE_DATE, q.NIGHTLY_AT, name="stored", src="staged_nightly"),
            """sizes AS (
  SELECT (SELECT count(*) FROM features) AS f, (SELECT count(*) FROM stored) AS w,
    (SELECT count(*) FROM features
      WHERE NOT (pct_online_txns_30d BETWEEN 0 AND 1 AND txn_count_30d >= 0)) AS bad
)""",
        )
        + """SELECT 'min_accounts' AS check_name, CAST(f AS DOUBLE) AS observed,
  CAST(100 AS DOUBLE) AS threshold, CASE WHEN f >= 100 THEN 'pass' ELSE 'warn' END AS status
FROM sizes
UNION ALL
SELECT 'written_ratio', CAST(w AS DOUBLE), f * 0.95::DOUBLE,
  CASE WHEN w >= f * 0.95::DOUBLE THEN 'pass' ELSE 'fail' END FROM sizes
UNION ALL
SELECT 'values_in_range', CAST(bad AS DOUBLE), 0.0::DOUBLE,
  CASE WHEN bad = 0 THEN 'pass' ELSE 'fail' END FROM sizes"""
    )
    age = f"(epoch_us(TIMESTAMP '{q.SERVE_AT}') - epoch_us(computed_at)) / 1000000.0::DOUBLE"
    out["q_freshness"] = served + "\nUNION ALL\n".join(
        f"""SELECT '{group}' AS feature_group, count(*) AS num_accounts,
  min({age}) AS min_age_seconds, max({age}) AS max_age_seconds FROM {table}"""
        for group, table in (("realtime", "live_rt"), ("batch", "live_bt"))
    )
    out["q_skew_report"] = (
        _with(
            TXNS,
            _staged(q.NOW),
            HOPS,
            TRAILING,
            NOVELTY,
            """hot AS (
  SELECT *, false AS is_new_merchant FROM hops
  QUALIFY row_number() OVER (PARTITION BY account_id ORDER BY window_end DESC) = 1
)""",
            """cold AS (
  SELECT account_id, txn_count_1h, txn_amount_sum_1h, txn_amount_max_1h, is_new_merchant
  FROM staged JOIN windowed USING (event_id) JOIN novelty USING (event_id)
  QUALIFY row_number() OVER (
    PARTITION BY account_id ORDER BY event_timestamp DESC, event_id DESC) = 1
)""",
        )
        + _skew()
    )
    return out
