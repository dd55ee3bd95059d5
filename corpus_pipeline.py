"""A corpus from raw documents, in five stages; each works on all that the one before it kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from crownlake.llm import exact_dedup, language_id, mixing, ngram_join, packing
from crownlake.llm.common import prepare, stored
from crownlake.llm.queries import tokenizer_path


def languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Language ID: documents without a language (null, empty or letterless text) go."""
    return language_id.recognised(docs)


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Exact dedup: of texts equal but for the case of A-Z, the row with the largest id stays."""
    return exact_dedup.deduplicate(docs)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """N-gram Jaccard join on word 5-grams at 0.8: of each linked group, the row with the smallest id stays."""
    return ngram_join.one_of_each(docs, n=5, percent=80)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Temperature mixing with every document: under-represented sources repeat, none over twice."""
    return mixing.mixed(docs, limit=2.0, budget_share=None)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Packing: pieces of token sequences along the space-filling curve."""
    return packing.pack(docs, tokenizer_path("word_bpe_49k.json"))


STAGES = [("language_id", languages), ("exact_dedup", exact), ("ngram_join", near), ("mixing", mix), ("packing", packed)]

# Learnt models and tokenizers: not expressible in SQL; the tests hold each stage against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result is written to the shared folder and read again."""
    prepare(spark)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
