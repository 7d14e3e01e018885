"""Queries op1 to op13 and the pipeline over the given tables."""

from __future__ import annotations

import corpus_pipeline
from pyspark.sql import DataFrame, SparkSession

from skyjoin.llm import bpe, hard_negatives, importance, licences, lm, mixing, near_dup, quality, sentence_pieces, shards, substrings, telephony
from skyjoin.llm.common import Stage
from skyjoin.llm.token_counts import token_counts


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dup.near_duplicates(documents(spark, sf_dir), Stage(spark, "op1"), size=4, percent=80)


def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.encode(documents(spark, sf_dir), with_ids=False).drop("ids")


def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shards.balanced_shards(documents(spark, sf_dir), Stage(spark, "op3"), shards=16)


def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substrings.remove_repeats(documents(spark, sf_dir), size=13).select("doc_id", "n_words", "n_removed", "kept_sha256")


def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts(documents(spark, sf_dir))


def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(documents(spark, sf_dir), Stage(spark, "op6")).select("doc_id", "size", "source_size", "target", "taken")


def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    return telephony.store(documents(spark, sf_dir), with_media=False).drop("media", "pcm")


def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality_rules(documents(spark, sf_dir)).drop("row")


def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licences.scan(licences.document_files(documents(spark, sf_dir)), Stage(spark, "op9"))


def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm.scores(documents(spark, sf_dir), Stage(spark, "op10"))


def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return importance.resample(documents(spark, sf_dir), benchmark, Stage(spark, "op11")).select("doc_id", "n_features", "weight", "score", "rank")


def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hard_negatives.mine(spark.read.parquet(f"{sf_dir}/embeddings.parquet"), Stage(spark, "op12"))


def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sentence_pieces.encode(documents(spark, sf_dir), with_spans=False).drop("pieces")


QUERIES = {
    "op1_near_duplicates": op1,
    "op2_byte_bpe": op2,
    "op3_balanced_shards": op3,
    "op4_substring_dedup": op4,
    "op5_token_counts": op5,
    "op6_source_mix": op6,
    "op7_telephony": op7,
    "op8_quality_rules": op8,
    "op9_licence_scan": op9,
    "op10_lm_scores": op10,
    "op11_importance_resampling": op11,
    "op12_hard_negatives": op12,
    "op13_sentence_pieces": op13,
    "pipeline": corpus_pipeline.run,
}
