"""Row shapes and data-contract values shared by every path."""

from __future__ import annotations

from pyspark.sql import types as T

# Enumerations, defaults, ranges, lifetimes and names of the data contract.
TRANSACTION_TYPES = ["purchase", "withdrawal", "transfer", "payment", "refund"]
EVENT_DEFAULTS = {
    "merchant_category": "unknown",
    "is_online": False,
    "card_present": True,
    "country_code": "US",
}
REALTIME_DEFAULTS = {
    "txn_count_1h": 0,
    "txn_amount_sum_1h": 0.0,
    "txn_amount_max_1h": 0.0,
    "txn_velocity_5m": 0.0,
    "is_new_merchant": False,
    "hour_of_day": 0,
    "is_weekend": False,
    "is_online": False,
    "card_present": True,
    "country_code": "US",
}
BATCH_DEFAULTS = {
    "avg_txn_amount_30d": 0.0,
    "txn_count_30d": 0,
    "distinct_merchants_30d": 0,
    "distinct_merchants_7d": 0,
    "txn_count_7d": 0,
    "txn_amount_p50_90d": 0.0,
    "txn_amount_p95_90d": 0.0,
    "txn_amount_p99_90d": 0.0,
    "days_since_last_txn": 0.0,
    "avg_daily_txn_count_30d": 0.0,
    "most_common_merchant_category": "unknown",
    "pct_online_txns_30d": 0.0,
}
LATITUDE_LIMIT = 90.0
LONGITUDE_LIMIT = 180.0
COUNTRY_CODE_LENGTH = 3
REALTIME_TTL_SECONDS = 3600
BATCH_TTL_SECONDS = 129600
VECTOR_VERSION = "1.0.0"
TRANSACTIONS_TOPIC = "fraud.transactions.raw"
REALTIME_SNAPSHOTS = "realtime_feature_snapshots"
BATCH_SNAPSHOTS = "batch_feature_snapshots"


def _struct(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in fields.items()])


TRANSACTION = _struct(
    event_id=T.StringType(),
    account_id=T.StringType(),
    event_timestamp=T.TimestampNTZType(),
    transaction_date=T.DateType(),
    amount=T.DoubleType(),
    merchant_id=T.StringType(),
    merchant_category=T.StringType(),
    transaction_type=T.StringType(),
    latitude=T.DoubleType(),
    longitude=T.DoubleType(),
    is_online=T.BooleanType(),
    card_present=T.BooleanType(),
    country_code=T.StringType(),
    ingested_at=T.TimestampNTZType(),
)

PROFILE = _struct(
    account_id=T.StringType(),
    home_latitude=T.DoubleType(),
    home_longitude=T.DoubleType(),
    registration_date=T.DateType(),
    account_type=T.StringType(),
    country_code=T.StringType(),
    updated_at=T.TimestampNTZType(),
)

REALTIME = _struct(
    account_id=T.StringType(),
    computed_at=T.TimestampNTZType(),
    txn_count_1h=T.LongType(),
    txn_amount_sum_1h=T.DoubleType(),
    txn_amount_max_1h=T.DoubleType(),
    txn_velocity_5m=T.DoubleType(),
    distance_from_home=T.DoubleType(),
    is_new_merchant=T.BooleanType(),
    hour_of_day=T.IntegerType(),
    is_weekend=T.BooleanType(),
    is_online=T.BooleanType(),
    card_present=T.BooleanType(),
    country_code=T.StringType(),
)

BATCH = _struct(
    account_id=T.StringType(),
    computed_at=T.TimestampNTZType(),
    avg_txn_amount_30d=T.DoubleType(),
    txn_count_30d=T.LongType(),
    distinct_merchants_30d=T.LongType(),
    distinct_merchants_7d=T.LongType(),
    txn_count_7d=T.LongType(),
    txn_amount_p50_90d=T.DoubleType(),
    txn_amount_p95_90d=T.DoubleType(),
    txn_amount_p99_90d=T.DoubleType(),
    days_since_last_txn=T.DoubleType(),
    avg_daily_txn_count_30d=T.DoubleType(),
    most_common_merchant_category=T.StringType(),
    pct_online_txns_30d=T.DoubleType(),
)

ROLLING = _struct(
    account_id=T.StringType(),
    computation_date=T.DateType(),
    window_days=T.IntegerType(),
    metric_name=T.StringType(),
    metric_value=T.DoubleType(),
    computed_at=T.TimestampNTZType(),
)

DEAD_LETTER = _struct(
    original_message=T.StringType(),
    error_reason=T.StringType(),
    source_topic=T.StringType(),
    source_partition=T.IntegerType(),
    source_offset=T.LongType(),
    failed_at=T.TimestampNTZType(),
    metadata=T.MapType(T.StringType(), T.StringType()),
)

# Message fields arrive as text and are cast one by one, so one bad field names itself instead of
# voiding the whole record.
MESSAGE = T.StructType(
    [
        T.StructField(name, T.StringType())
        for name in [
            "event_id",
            "account_id",
            "timestamp",
            "amount",
            "merchant_id",
            "merchant_category",
            "transaction_type",
            "latitude",
            "longitude",
            "is_online",
            "card_present",
            "country_code",
            "_corrupt",
        ]
    ]
)

REALTIME_FEATURES = [f.name for f in REALTIME if f.name not in ("account_id", "computed_at")]
BATCH_FEATURES = [f.name for f in BATCH if f.name not in ("account_id", "computed_at")]
