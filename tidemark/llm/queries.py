"""The operators as queries over whole tables, with production parameters."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import archive, bins, clustering, credentials, jaccard, licenses, multi_index
from tidemark.llm import packing, quality, sharding, sql, tiling, token_counts, whitening
from tidemark.llm.common import Query, table
from tidemark.session import run_dir

TOKENIZER = "byte_bpe_50k.json"
WORD_TOKENIZER = "word_bpe_49k.json"


def op1_packing(spark: SparkSession, folder: str) -> DataFrame:
    tokenizer = public_tokenizers.path(TOKENIZER)
    return packing.pack(table(spark, folder, "documents"), tokenizer, keep_ids=False)


def op2_multi_index(spark: SparkSession, folder: str) -> DataFrame:
    return multi_index.nearest(table(spark, folder, "embeddings"))


def op3_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    docs, items = table(spark, folder, "documents"), table(spark, folder, "benchmark")
    return tiling.contamination(docs, items).drop("text_key")


def op4_secrets(spark: SparkSession, folder: str) -> DataFrame:
    return credentials.find_secrets(table(spark, folder, "documents"))


def op5_quality(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    return quality.score(docs, quality.train(docs, table(spark, folder, "labels")))


def op6_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    tokenizer = public_tokenizers.path(TOKENIZER)
    return token_counts.token_counts(table(spark, folder, "documents"), tokenizer)


def op7_sharding(spark: SparkSession, folder: str) -> DataFrame:
    return sharding.shard(table(spark, folder, "documents"))


def op8_jaccard_join(spark: SparkSession, folder: str) -> DataFrame:
    return jaccard.linked(table(spark, folder, "documents"))


def op9_licenses(spark: SparkSession, folder: str) -> DataFrame:
    return licenses.licenses(table(spark, folder, "documents"))


def op10_warc(spark: SparkSession, folder: str) -> DataFrame:
    path = run_dir(spark, "archive")
    archive.write_archive(table(spark, folder, "pages"), path)
    return archive.summary(archive.read_records(spark, path))


def op11_best_fit(spark: SparkSession, folder: str) -> DataFrame:
    tokenizer = public_tokenizers.path(WORD_TOKENIZER)
    return bins.pack(table(spark, folder, "documents"), tokenizer, keep_ids=False)


def op12_clustering(spark: SparkSession, folder: str) -> DataFrame:
    return clustering.clusters(table(spark, folder, "embeddings"))


def op13_whitening(spark: SparkSession, folder: str) -> DataFrame:
    rows = whitening.whitened(table(spark, folder, "embeddings"))
    # A long holds the deviations of some ten million vectors; beyond it the cell is null.
    return rows.withColumn("deviation", F.col("deviation").try_cast("long"))


def registered() -> dict[str, Query]:
    found = (
        op1_packing, op2_multi_index, op3_decontamination, op4_secrets, op5_quality,
        op6_token_counts, op7_sharding, op8_jaccard_join, op9_licenses, op10_warc,
        op11_best_fit, op12_clustering, op13_whitening,
    )
    return {f.__name__: f for f in found}


def oracle_sql() -> dict[str, str]:
    """SQL for the queries that it can express; the others are tested against brute force."""
    return {
        "op7_sharding": sql.sharding(sharding.LIMIT),
        "op8_jaccard_join": sql.jaccard(jaccard.WIDTH, jaccard.PERCENT),
        "op10_warc": sql.WARC,
        "op12_clustering": sql.clustering(
            clustering.CENTROIDS, clustering.ROUNDS, clustering.DIMENSIONS
        ),
    }
