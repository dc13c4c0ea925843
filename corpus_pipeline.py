"""Raw documents to training tokens: toxic documents, near copies and benchmark leaks go, personal data is masked.

STAGES are (name, function); a function takes (spark, docs, sf_dir) and its result, written and read again, is the
next one's docs. All but the last keep the columns of ``documents``. Tables besides the documents come from sf_dir.
Every row is judged by its own text, also when rows share a doc_id or have none; of linked rows one stays.
Empty tables pass through as empty tables.
"""

from __future__ import annotations

import uuid

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docflow.llm import bpe, decontam, jaccard, pii, toxicity
from docflow.llm.common import lean, table
from docflow.session import shared_dir


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Toxicity (6): rejected documents go. The model learns from the labelled documents that reach the stage."""
    lean(spark)
    return toxicity.drop_toxic(docs, toxicity.fit(docs, table(spark, sf_dir, "labels")))


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """N-gram Jaccard join (8): of each group of linked rows one with the smallest id stays."""
    lean(spark)
    return jaccard.keep_one(docs)


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Benchmark decontamination (3): rows that hold a window of a test item go."""
    lean(spark)
    return decontam.drop_contaminated_rows(docs, table(spark, sf_dir, "benchmark"))


def mask_personal(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """PII (7): spans become their kind in brackets; ``n_chars`` follows the text."""
    lean(spark)
    out = pii.redact(docs)
    if "n_chars" in out.columns:
        out = out.withColumn("n_chars", F.when(F.col("text").isNull(), F.col("n_chars")).otherwise(
            F.length("text")).cast(docs.schema["n_chars"].dataType))
    return out.select(docs.columns)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """BPE (2): doc_id, n_tokens and digests of ids and decoded text."""
    lean(spark)
    return bpe.digest(docs, public_tokenizers.path("byte_bpe_50k.json"))


STAGES = [
    ("toxicity", drop_toxic),
    ("near_duplicates", drop_copies),
    ("decontamination", drop_leaks),
    ("pii", mask_personal),
    ("bpe", tokens),
]
ORACLE_SQL = None  # a trained classifier and a tokenizer are not SQL; tests hold run() against brute force


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written to the shared folder and read again."""
    docs = table(spark, sf_dir, "documents")
    folder = f"{shared_dir(spark).rstrip('/')}/docflow/pipeline-{uuid.uuid4().hex}"
    for name, stage in STAGES[:-1]:
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
