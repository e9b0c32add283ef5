"""From raw documents to packed training sequences.

Each stage takes (spark, docs, sf_dir) and returns a frame; it is written as Parquet, and what is read back is the next
stage's input. All stages but the last return the columns of documents.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from orderlens.llm import mixing, ngram_join, packing, quality, secrets
from orderlens.llm.common import written


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the rules reject go."""
    return quality.kept(docs)


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of linked documents the one with the smallest id stays."""
    return ngram_join.one_of_each(docs)


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets inside texts are masked; no document goes."""
    masked = secrets.redact(docs)
    return masked.withColumn("n_chars", F.char_length("text").cast(docs.schema["n_chars"].dataType))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents stand as often as the mix takes them; the one that ends a source's share is cut to its words."""
    return mixing.sample(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces with their sequence and place in it."""
    return packing.packed_documents(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [
    ("quality_rules", quality_rules),
    ("ngram_jaccard_join", one_of_each_group),
    ("secret_scan", mask_secrets),
    ("mix_sources", mix_sources),
    ("pack_sequences", pack_sequences),
]

# Secret lexing, component search and tokenizers have no SQL form; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
