"""A training corpus from documents: quality, one of each near copy, decontamination, secrets, packing.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written as Parquet and read
again for the next. All but the last return the columns of documents.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from tidemark.llm import credentials, jaccard, packing, quality, tiling
from tidemark.llm.common import bounded_batches, stored, table


def reject_low_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier, fitted on their labels, does not reject."""
    bounded_batches(spark)
    return quality.accepted(docs, quality.train(docs, table(spark, sf_dir, "labels")))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group linked by shingles of five words and a similarity of 0.8."""
    bounded_batches(spark)
    return jaccard.one_of_each(docs, width=5, percent=80)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    bounded_batches(spark)
    return tiling.clean(docs, table(spark, sf_dir, "benchmark"))


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with secrets in their texts replaced."""
    bounded_batches(spark)
    return credentials.redact(docs)


def pack_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents, with their ids, in sequences of at most 2048 ids."""
    bounded_batches(spark)
    return packing.pack(docs, public_tokenizers.path("byte_bpe_50k.json"))


STAGES = [
    ("quality", reject_low_quality),
    ("near_copies", drop_near_copies),
    ("decontamination", decontaminate),
    ("secrets", redact_secrets),
    ("packing", pack_tokens),
]

# No SQL expresses the classifier; each stage is tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), name)
    return docs
