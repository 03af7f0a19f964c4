"""Catalogue of features: which path computes each, its type, window and tags."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Name, path, data type, window, tags.
LISTED = [
    ("txn_count_1h", "hot", "int", "1h", ["velocity", "fraud-signal"]),
    ("txn_amount_sum_1h", "hot", "float", "1h", ["velocity", "amount"]),
    ("txn_amount_max_1h", "hot", "float", "1h", ["velocity", "amount", "anomaly"]),
    ("txn_velocity_5m", "hot", "float", "5m", ["velocity", "fraud-signal"]),
    ("distance_from_home", "hot", "float", "point", ["geo", "fraud-signal"]),
    ("is_new_merchant", "hot", "bool", "point", ["behavioral", "fraud-signal"]),
    ("hour_of_day", "hot", "int", "point", ["temporal"]),
    ("is_weekend", "hot", "bool", "point", ["temporal"]),
    ("avg_txn_amount_30d", "cold", "float", "30d", ["baseline", "amount"]),
    ("txn_count_30d", "cold", "int", "30d", ["baseline", "velocity"]),
    ("distinct_merchants_7d", "cold", "int", "7d", ["behavioral", "diversity"]),
    ("distinct_merchants_30d", "cold", "int", "30d", ["behavioral", "diversity"]),
    ("txn_amount_p95_90d", "cold", "float", "90d", ["percentile", "anomaly", "fraud-signal"]),
    ("txn_amount_p99_90d", "cold", "float", "90d", ["percentile", "anomaly"]),
    ("days_since_last_txn", "cold", "float", "point", ["behavioral", "dormancy"]),
    ("pct_online_txns_30d", "cold", "float", "30d", ["channel", "behavioral"]),
]

# Features that are computed and served but missing from the list above.
COMPLETION = [
    ("is_online", "hot", "bool", "point", ["channel"]),
    ("card_present", "hot", "bool", "point", ["channel"]),
    ("country_code", "hot", "string", "point", ["geo"]),
    ("txn_count_7d", "cold", "int", "7d", ["baseline", "velocity"]),
    ("txn_amount_p50_90d", "cold", "float", "90d", ["percentile"]),
    ("avg_daily_txn_count_30d", "cold", "float", "30d", ["baseline", "velocity"]),
    ("most_common_merchant_category", "cold", "string", "90d", ["behavioral"]),
]

# Spark types that may carry each registry type.
_CARRIERS = {
    "int": {"int", "bigint"},
    "float": {"double", "float"},
    "bool": {"boolean"},
    "string": {"string"},
}


def _entries(complete: bool) -> list[tuple]:
    return [*LISTED, *COMPLETION] if complete else LISTED


def registry_frame(spark: SparkSession, complete: bool = True) -> DataFrame:
    """The catalogue as a frame; ``complete=False`` gives the sixteen listed entries only."""
    rows = [
        (i, name, path, kind, window, tags, False, "1.0.0")
        for i, (name, path, kind, window, tags) in enumerate(_entries(complete))
    ]
    return spark.createDataFrame(
        rows,
        "position int, name string, path string, data_type string, window string, "
        "tags array<string>, is_deprecated boolean, version string",
    )


def active_features(spark: SparkSession, complete: bool = True) -> DataFrame:
    return registry_frame(spark, complete).where(~F.col("is_deprecated"))


def features_by_path(spark: SparkSession, path: str, complete: bool = True) -> DataFrame:
    return active_features(spark, complete).where(F.col("path") == path)


def features_by_tag(spark: SparkSession, tag: str, complete: bool = True) -> DataFrame:
    return active_features(spark, complete).where(F.array_contains("tags", tag))


def feature_names(path: str | None = None, tag: str | None = None, complete: bool = True) -> list[str]:
    return [
        name
        for name, its_path, _, _, tags in _entries(complete)
        if (path is None or its_path == path) and (tag is None or tag in tags)
    ]


def select_features(
    df: DataFrame, path: str | None = None, tag: str | None = None, complete: bool = True
) -> DataFrame:
    """account_id and the selected features that the frame has; the scan reads only those."""
    wanted = feature_names(path, tag, complete)
    return df.select("account_id", *[n for n in wanted if n in df.columns])


def schema_report(df: DataFrame, path: str | None = None, complete: bool = True) -> DataFrame:
    """Registry against a frame's schema: one row per feature with status ok, missing or type."""
    actual = dict(df.dtypes)
    rows = []
    for name, its_path, kind, _, _ in _entries(complete):
        if path is not None and its_path != path:
            continue
        found = actual.get(name)
        status = "missing" if found is None else "ok" if found in _CARRIERS[kind] else "type"
        rows.append((name, kind, found, status))
    return df.sparkSession.createDataFrame(
        rows, "name string, expected string, actual string, status string"
    )


def feature_profile(df: DataFrame, path: str | None = None, complete: bool = True) -> DataFrame:
    """Per numeric or boolean feature: how many accounts carry it, and its range.

    One aggregation over the frame, turned into rows afterwards.
    """
    actual = dict(df.dtypes)
    numeric = set().union(*[_CARRIERS[k] for k in ("int", "float", "bool")])
    entries = [
        (name, its_path, window)
        for name, its_path, _, window, _ in _entries(complete)
        if (path is None or its_path == path) and actual.get(name) in numeric
    ]

    def number(name: str):
        column = F.col(name)
        return (column.cast("int") if actual[name] == "boolean" else column).cast("double")

    measured = df.agg(
        *[F.count(n).alias(f"{n}__n") for n, _, _ in entries],
        *[F.min(number(n)).alias(f"{n}__low") for n, _, _ in entries],
        *[F.max(number(n)).alias(f"{n}__high") for n, _, _ in entries],
    )
    rows = F.array(
        *[
            F.struct(
                F.lit(n).alias("feature"),
                F.lit(p).alias("path"),
                F.lit(w).alias("window"),
                F.col(f"{n}__n").alias("num_accounts"),
                F.col(f"{n}__low").alias("min_value"),
                F.col(f"{n}__high").alias("max_value"),
            )
            for n, p, w in entries
        ]
    )
    return measured.select(F.inline(rows))
