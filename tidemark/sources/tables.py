"""The given parquet tables, shaped as transactions, profiles and messages."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.keys import route_partition
from tidemark.schemas import TRANSACTIONS_TOPIC


def read(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def account(key: Column) -> Column:
    return F.concat(F.lit("acct_"), key.cast("string"))


def transactions_from(events: DataFrame) -> DataFrame:
    """Card transactions from the ``events`` table (static or streaming)."""
    return events.selectExpr(
        "concat('evt_', CAST(event_id AS string)) AS event_id",
        "concat('acct_', CAST(user_id AS string)) AS account_id",
        "ts AS event_timestamp",
        "CAST(ts AS date) AS transaction_date",
        "value AS amount",
        "concat('merch_', regexp_extract(props, '[0-9]+', 0)) AS merchant_id",
        "CASE WHEN event_id % 13 <> 0 THEN upper(event_type) END AS merchant_category",
        "CASE event_type WHEN 'purchase' THEN 'purchase' WHEN 'click' THEN 'payment' "
        "WHEN 'view' THEN 'transfer' WHEN 'signup' THEN 'withdrawal' ELSE 'error' END "
        "AS transaction_type",
        "CASE WHEN event_id % 10 <> 0 "
        "THEN CAST((event_id * 7919) % 18001 AS double) / 100D - 90D END AS latitude",
        "CASE WHEN event_id % 10 <> 0 "
        "THEN CAST((event_id * 104729) % 36001 AS double) / 100D - 180D END AS longitude",
        "CASE WHEN event_id % 11 <> 0 THEN event_id % 3 = 0 END AS is_online",
        "CASE WHEN event_id % 17 <> 0 THEN event_id % 3 <> 0 END AS card_present",
        "CASE WHEN event_id % 19 <> 0 THEN CASE WHEN event_id % 7 = 0 THEN 'CA' ELSE 'US' END END "
        "AS country_code",
        "ts AS ingested_at",
    )


def transactions(spark: SparkSession, folder: str) -> DataFrame:
    return transactions_from(read(spark, folder, "events"))


def card_history(spark: SparkSession, folder: str) -> DataFrame:
    """Seven years of transactions for the nightly path, from orders and their line items."""
    orders = read(spark, folder, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    lines = read(spark, folder, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        "l_suppkey",
        "l_extendedprice",
        "l_returnflag",
        "l_linestatus",
    )
    joined = lines.join(orders, lines.l_orderkey == orders.o_orderkey)
    return joined.selectExpr(
        "concat_ws('_', 'line', l_orderkey, l_linenumber) AS event_id",
        "concat('acct_', CAST(o_custkey AS string)) AS account_id",
        "o_orderdate AS event_timestamp",
        "CAST(o_orderdate AS date) AS transaction_date",
        "l_extendedprice AS amount",
        "concat('merch_', CAST(l_suppkey AS string)) AS merchant_id",
        "l_returnflag AS merchant_category",
        "'purchase' AS transaction_type",
        "CAST(NULL AS double) AS latitude",
        "CAST(NULL AS double) AS longitude",
        "l_linestatus = 'O' AS is_online",
        "l_linestatus <> 'O' AS card_present",
        "'US' AS country_code",
        "o_orderdate AS ingested_at",
    )


def profiles(spark: SparkSession, folder: str) -> DataFrame:
    return read(spark, folder, "customer").selectExpr(
        "concat('acct_', CAST(c_custkey AS string)) AS account_id",
        "CASE WHEN c_custkey % 9 <> 0 "
        "THEN CAST((c_custkey * 31) % 18001 AS double) / 100D - 90D END AS home_latitude",
        "CASE WHEN c_custkey % 9 <> 0 "
        "THEN CAST((c_custkey * 37) % 36001 AS double) / 100D - 180D END AS home_longitude",
        "lower(c_mktsegment) AS account_type",
        "'US' AS country_code",
    )


MOVED_AT = "2024-01-16 12:00:00"  # when every third account moves


def profile_history(spark: SparkSession, folder: str) -> DataFrame:
    """Profiles with ``updated_at``; every third account has a second version, in another place."""
    first = profiles(spark, folder).withColumn(
        "updated_at", F.lit("2024-01-02 00:00:00").cast("timestamp_ntz")
    )
    number = F.regexp_extract("account_id", "([0-9]+)$", 1).cast("bigint")
    moved = first.where(number % 3 == 0).withColumns(
        {
            "home_latitude": -F.col("home_latitude"),
            "home_longitude": F.col("home_longitude") / 2,
            "updated_at": F.lit(MOVED_AT).cast("timestamp_ntz"),
        }
    )
    return first.unionByName(moved)


def messages_from(txns: DataFrame, spell_nulls: bool = False) -> DataFrame:
    """Transactions as broker messages: key, JSON value and the source position.

    Fields without a value are left away, or are there as null with ``spell_nulls``.
    """
    body = F.struct(
        "event_id",
        "account_id",
        F.date_format("event_timestamp", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'").alias("timestamp"),
        "amount",
        "merchant_id",
        "merchant_category",
        "transaction_type",
        "latitude",
        "longitude",
        "is_online",
        "card_present",
        "country_code",
    )
    return txns.select(
        F.col("account_id").alias("key"),
        F.to_json(body, {"ignoreNullFields": str(not spell_nulls).lower()}).alias("value"),
        F.lit(TRANSACTIONS_TOPIC).alias("topic"),
        route_partition(F.col("account_id")).alias("partition"),
        F.regexp_extract("event_id", "([0-9]+)$", 1).cast("bigint").alias("offset"),
    )
