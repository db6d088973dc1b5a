"""The registered queries of this subpackage: (spark, sf_dir) -> DataFrame."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from stintlake.llm import bpe, fim, fingerprint, importance, language, media, mixing, near_dedup, quality, secrets, substring_dedup, textops, toxicity, warc


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    textops.small_batches(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_quality_machine(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.classify(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op2_scaled_sketch(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprint.compare_with_next(_table(spark, sf_dir, "documents"))


def op3_order_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.find(_table(spark, sf_dir, "documents"))


def op4_mpeg_audio(spark: SparkSession, sf_dir: str) -> DataFrame:
    return media.digest(_table(spark, sf_dir, "documents"))


def op5_bpe_segment_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.encode_and_decode(_table(spark, sf_dir, "documents"))


def op6_language_centroids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language.identify(_table(spark, sf_dir, "documents"))


def op7_secret_battery(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.report(_table(spark, sf_dir, "documents"))


def op8_mixing_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(_table(spark, sf_dir, "documents"))


def op9_repeated_bytes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.report(_table(spark, sf_dir, "documents"))


def op10_toxicity_subwords(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.detect(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op11_bit_sliced_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return importance.resample(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op12_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fim.report(_table(spark, sf_dir, "documents"))


def op13_warc_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.archive(_table(spark, sf_dir, "pages"))


QUERIES = {f.__name__: f for f in (op1_quality_machine, op2_scaled_sketch, op3_order_minhash, op4_mpeg_audio, op5_bpe_segment_tree, op6_language_centroids, op7_secret_battery, op8_mixing_tree, op9_repeated_bytes, op10_toxicity_subwords, op11_bit_sliced_resampling, op12_fill_in_middle, op13_warc_shards)}
ORACLES: dict[str, str] = {"op8_mixing_tree": mixing.ORACLE_SQL, "op11_bit_sliced_resampling": importance.ORACLE_SQL, "op12_fill_in_middle": fim.ORACLE_SQL, "op13_warc_shards": warc.ORACLE_SQL}
