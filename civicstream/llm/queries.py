"""Registered queries of this subpackage: each applies one operator to whole tables."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from civicstream.llm import bpe, common, decontam, egojoin, knlm, langid, linededup, oracle, periodic, phrases, quality, setsketch, suffix, tokenfile, toxicity

RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")

TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    common.prepare(spark)
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def op1_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.digest(documents(spark, sf_dir), RANKS)


def op2_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.digest(documents(spark, sf_dir))


def op3_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.digest(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.digest(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet"))


def op5_kneser_ney(spark: SparkSession, sf_dir: str) -> DataFrame:
    return knlm.digest(documents(spark, sf_dir))


def op6_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix.digest(documents(spark, sf_dir))


def op7_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.digest(documents(spark, sf_dir))


def op8_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokenfile.digest(documents(spark, sf_dir), TOKENIZER, end_id=2)


def op9_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return linededup.digest(documents(spark, sf_dir))


def op10_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return setsketch.near_duplicates(documents(spark, sf_dir))


def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return periodic.digest(documents(spark, sf_dir))


def op12_vector_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return egojoin.near_duplicates(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


def op13_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrases.digest(documents(spark, sf_dir))


QUERIES = {"op1_bpe": op1_bpe, "op2_quality": op2_quality, "op3_decontamination": op3_decontamination, "op4_toxicity": op4_toxicity,
           "op5_kneser_ney": op5_kneser_ney, "op6_suffix_dedup": op6_suffix_dedup,
           "op7_language": op7_language, "op8_token_files": op8_token_files,
           "op9_line_dedup": op9_line_dedup, "op10_near_dedup": op10_near_dedup, "op11_periodic_runs": op11_periodic_runs,
           "op12_vector_dedup": op12_vector_dedup, "op13_phrases": op13_phrases}

ORACLE: dict[str, str] = {"op2_quality": oracle.QUALITY, "op9_line_dedup": oracle.LINE_DEDUP,
                          "op3_decontamination": oracle.DECONTAMINATION, "op12_vector_dedup": oracle.VECTOR_DEDUP,
                          "op13_phrases": oracle.PHRASES}
