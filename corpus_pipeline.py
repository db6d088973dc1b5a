"""The corpus pipeline: five stages over documents, each written as Parquet and read back by the next.

Every stage takes (spark, docs, sf_dir) and works on all rows that its predecessor kept. All but the
last return the columns of documents.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from stintlake.llm import bpe, mixing, near_dedup, quality, scratch, secrets, textops


def _small_batches(stage: Callable) -> Callable:
    def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        textops.small_batches(spark)
        return stage(spark, docs, sf_dir)

    return run_stage


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops the documents that the factorisation machine rejects."""
    return quality.keep_good(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each class of near copies."""
    return near_dedup.keep_one(docs)


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replaces secrets in the texts."""
    return secrets.redact(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Brings domains, languages and sources to their target weights; some rows come twice."""
    return mixing.take(docs)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Encodes and decodes every text: doc_id, n_tokens, ids_sha256, decoded_sha256 and the ids."""
    return bpe.encode_and_decode(docs, ids=True)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality_classifier", _small_batches(quality_classifier)),
    ("near_duplicates", _small_batches(near_duplicates)),
    ("secret_scan", _small_batches(secret_scan)),
    ("mix_sources", _small_batches(mix_sources)),
    ("tokens", _small_batches(tokens)),
]
#: No SQL: the classifier and the tokens have none. Tests compare the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES[:-1]:
        docs = scratch.keep(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
