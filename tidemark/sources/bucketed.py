"""Tables dealt by account when they are written, so that joins on it move nothing when they are read."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

BUCKETS = 64


def write_bucketed(
    df: DataFrame, name: str, path: str, buckets: int = BUCKETS, key: str = "account_id"
) -> None:
    """Store a table of the catalogue under path, in buckets of the key, each sorted by it.

    Rows are dealt by the key before they are written, so that a bucket is one file and not one for
    every task. Tables that are joined need the same number of buckets; size it for files of a few
    hundred megabytes.
    """
    (
        df.repartition(buckets, key)
        .write.mode("overwrite")
        .option("path", path)
        .bucketBy(buckets, key)
        .sortBy(key)
        .saveAsTable(name)
    )


def read_bucketed(spark: SparkSession, name: str) -> DataFrame:
    return spark.table(name)
