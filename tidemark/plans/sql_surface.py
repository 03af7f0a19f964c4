"""Feature tables as objects of a SQL session: views, and functions that take a moment or an account.

After ``register`` the following are plain SQL:

    SELECT * FROM account_features                                  every stored date
    SELECT * FROM latest_account_features                           the newest date
    SELECT * FROM features_as_of(TIMESTAMP_NTZ '2024-01-20 00:00')  what was known then
    SELECT * FROM account_history('acct_7', <from>, <to>)           one account's snapshots
    SELECT * FROM served_features(TIMESTAMP_NTZ '…')                what a reader is served at a moment
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from tidemark import schemas as S
from tidemark.operators.daily import latest_features


def _columns(schema: T.StructType) -> str:
    return ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in schema)


def register(
    spark: SparkSession, daily: DataFrame, snapshots: DataFrame, served: DataFrame | None = None
) -> None:
    """Make the objects of this session from stored tables; the session's are replaced.

    daily: feature rows by computation_date. snapshots: realtime rows with committed_at and snapshot_id.
    served: serving rows with written_at and expires_at.
    """
    daily.createOrReplaceTempView("account_features")
    latest_features(daily).createOrReplaceTempView("latest_account_features")
    snapshots.createOrReplaceTempView("feature_snapshots")
    stamped = T.StructType(
        [
            *S.REALTIME.fields,
            T.StructField("committed_at", T.TimestampNTZType()),
            T.StructField("snapshot_id", T.LongType()),
        ]
    )
    rest = [n for n in stamped.names if n != "account_id"]
    picked = ", ".join(f"v.{n}" for n in rest)
    spark.sql(
        f"""CREATE OR REPLACE TEMPORARY FUNCTION features_as_of(moment TIMESTAMP_NTZ)
        RETURNS TABLE ({_columns(stamped)})
        RETURN SELECT account_id, {picked} FROM (
          SELECT account_id,
            max_by(struct({", ".join(rest)}), struct(computed_at, snapshot_id)) AS v
          FROM feature_snapshots WHERE committed_at <= moment GROUP BY account_id)"""
    )
    spark.sql(
        f"""CREATE OR REPLACE TEMPORARY FUNCTION account_history(
          account STRING, since TIMESTAMP_NTZ, until TIMESTAMP_NTZ)
        RETURNS TABLE ({_columns(stamped)})
        RETURN SELECT {", ".join(stamped.names)} FROM feature_snapshots
        WHERE account_id = account AND computed_at BETWEEN since AND until"""
    )
    if served is None:
        return
    served.createOrReplaceTempView("serving_rows")
    names = [n for n in served.columns if n not in ("account_id", "batch_id")]
    kinds = T.StructType([f for f in served.schema if f.name != "batch_id"])
    spark.sql(
        f"""CREATE OR REPLACE TEMPORARY FUNCTION served_features(moment TIMESTAMP_NTZ)
        RETURNS TABLE ({_columns(T.StructType([kinds["account_id"], *[kinds[n] for n in names]]))})
        RETURN SELECT account_id, {", ".join(f"v.{n}" for n in names)} FROM (
          SELECT account_id,
            max_by(struct({", ".join(names)}), struct(written_at, batch_id)) AS v
          FROM serving_rows WHERE written_at <= moment GROUP BY account_id)
        WHERE v.expires_at > moment"""
    )
