"""From raw documents to packed training batches, in five stages.

Every stage takes the documents that its predecessor kept; all but the last return the
columns of ``documents``. Stage results are written as Parquet in the shared folder and read
again, so a lost executor costs one stage at most.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from cdc_lake.llm import decontaminate, jaccard_join, packing, quality_classifier, secret_scan, token_counts
from cdc_lake.llm.common import read, stored

TOKENIZER = "piece_bpe_32k.model"


def classify_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents at or below the perplexity limit of their language."""
    return quality_classifier.kept_only(docs, read(spark, sf_dir, "labels"))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of copies and near copies."""
    return jaccard_join.one_of_each(docs)


def drop_benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    return decontaminate.without_leaks(docs, read(spark, sf_dir, "benchmark"))


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with a mark in place of each secret; ``n_chars`` follows the text."""
    return secret_scan.redact(docs)


def pack_batches(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The place of every document in a batch of a token budget."""
    counted = token_counts.token_counts(docs, public_tokenizers.path(TOKENIZER))
    return packing.pack(stored(counted.select("doc_id", "n_tokens"), "lengths"))


STAGES = [
    ("quality classifier", classify_quality),
    ("n-gram Jaccard join", drop_near_copies),
    ("benchmark decontamination", drop_benchmark_leaks),
    ("secret scans", redact_secrets),
    ("packing", pack_batches),
]

#: The stages count subwords, train models and compare sets of n-grams: not for SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), name.replace(" ", "_"))
    return docs
