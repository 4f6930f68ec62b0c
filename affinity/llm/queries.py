"""Registered queries of the corpus operators: ``opN_<name>(spark, sf_dir)``."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from . import ann, audit, bpe, bytebpe, langid, license, linededup, lm, minhash, mixing, quality, resample, toxicity
from .common import table


def op1_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.score(table(spark, sf_dir, "documents").select("doc_id", "text"))


def op9_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return linededup.digest(table(spark, sf_dir, "documents").select("doc_id", "text"))


def op10_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(table(spark, sf_dir, "documents").select("doc_id", "text"), shingle=2)


def op5_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.taken(table(spark, sf_dir, "documents"))


def op6_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return bpe.code(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


def op7_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.identify(table(spark, sf_dir, "documents").select("doc_id", "text", "lang"))


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.score(table(spark, sf_dir, "documents").select("doc_id", "text"),
                          table(spark, sf_dir, "labels").select("doc_id", "toxic"))


def op2_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    return ann.nearest(vectors, ann.usable(vectors, "vec_id", "embedding").filter("vec_id % 50 = 0"), k=5)


def op4_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm.score(table(spark, sf_dir, "documents").select("doc_id", "text"))


def op3_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license.scan(table(spark, sf_dir, "documents").select("doc_id", "text"))


def op11_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return bytebpe.code(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_multi_50k.tiktoken"),
                        public_tokenizers.PATTERN)


def op12_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resample.draw(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op13_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit.audit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def queries():
    return {
        "op1_quality_rules": op1_quality_rules,
        "op2_nearest_neighbours": op2_nearest_neighbours,
        "op3_license_scan": op3_license_scan,
        "op4_lm_scoring": op4_lm_scoring,
        "op5_mixing": op5_mixing,
        "op6_bpe": op6_bpe,
        "op7_language_id": op7_language_id,
        "op8_toxicity": op8_toxicity,
        "op9_line_dedup": op9_line_dedup,
        "op10_minhash": op10_minhash,
        "op11_byte_bpe": op11_byte_bpe,
        "op12_resampling": op12_resampling,
        "op13_filter_audit": op13_filter_audit,
    }
