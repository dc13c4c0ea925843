"""Registered queries of the subpackage: each operator over its whole table with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

import corpus_pipeline
import public_tokenizers
from docflow.llm import (
    bpe, class_lm, conversations, decontam, divergence, jaccard, mixing, oracles, pages, pii, quality, token_files, toxicity, vectors,
)
from docflow.llm.common import table


def language_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    return class_lm.score(table(spark, sf_dir, "documents"))


def round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.digest(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


def main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pages.main_text(table(spark, sf_dir, "pages"))


def id_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_files.round_trip(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


def decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def toxic(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def personal(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.digest(table(spark, sf_dir, "documents"))


def near_copies(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.join(table(spark, sf_dir, "documents"))


def near_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vectors.near_duplicates(table(spark, sf_dir, "embeddings"))


def good(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def repaired(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversations.digest(conversations.damage(table(spark, sf_dir, "conversations")))


def divergent(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.audit(table(spark, sf_dir, "documents"))


def mixed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.digest(table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_class_lm": language_model,
    "op2_chunked_bpe": round_trip,
    "op3_decontamination": decontamination,
    "op4_main_text": main_text,
    "op5_token_files": id_files,
    "op6_toxicity": toxic,
    "op7_pii": personal,
    "op8_jaccard_join": near_copies,
    "op9_embedding_dedup": near_vectors,
    "op10_quality": good,
    "op11_conversation_repair": repaired,
    "op12_source_divergence": divergent,
    "op13_source_mixing": mixed,
    "pipeline": corpus_pipeline.run,
}
ORACLES: dict[str, str] = {
    "op3_decontamination": oracles.DECONTAMINATION,
    "op7_pii": oracles.PERSONAL,
    "op8_jaccard_join": oracles.JACCARD,
    "op9_embedding_dedup": oracles.VECTORS,
    "op11_conversation_repair": oracles.CONVERSATIONS,
    "op12_source_divergence": oracles.DIVERGENCE,
    "op13_source_mixing": oracles.MIXING,
}
