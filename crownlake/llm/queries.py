"""Registered queries of the text operators: ``opN_<name>(spark, sf_dir)`` over whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from crownlake.llm import exact_dedup, fingerprints, language_id, license_scan, mixing, ngram_join, packing, periodic_runs, pii, quality
from crownlake.llm import secret_scan, token_counts, vector_codes
from crownlake.llm.common import prepare


def tokenizer_path(name: str) -> str:
    """Place of a public tokenizer's file on this machine."""
    import public_tokenizers

    return public_tokenizers.path(name)


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_id.language_report(documents(spark, sf_dir))


def op2_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secret_scan.find_secrets(documents(spark, sf_dir))

    def count(kind: str) -> Column:
        return F.size(F.filter("kinds", lambda k: k == F.lit(kind))).cast("long").alias(f"n_{kind}")

    return found.select("doc_id", count("assign"), count("access"), count("hex"), F.sha2("base", 256).alias("base_sha256"), "spans")


def op3_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.report(documents(spark, sf_dir))


def op4_curve_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(documents(spark, sf_dir), tokenizer_path("word_bpe_49k.json"))


def op5_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.edit_report(documents(spark, sf_dir))


def op6_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.linked_groups(documents(spark, sf_dir), n=3, percent=90)


def op7_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.decisions(documents(spark, sf_dir))


def op8_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality_report(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet"))


def op9_temperature_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """As many tokens as there are, at 98 % of the highest entropy over sources, no source over four times."""
    return mixing.mixture(documents(spark, sf_dir), target=0.98, limit=4.0)


def op10_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.count_tokens(documents(spark, sf_dir), tokenizer_path("piece_bpe_32k.model"))


def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every tenth text gets a periodic tail first, as the query's contract has it."""
    planted = periodic_runs.with_planted_periods(documents(spark, sf_dir))
    return periodic_runs.run_digests(periodic_runs.find_runs(planted, min_length=12))


def op12_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.license_report(license_scan.find_licenses(documents(spark, sf_dir)))


def op13_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    return vector_codes.code_report(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


def all_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: fn for name, fn in globals().items() if name.startswith("op") and callable(fn)}


ORACLE: dict[str, str] = {
    "op7_exact_dedup": """
        WITH n AS (
            SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t
            FROM documents),
        g AS (SELECT t, max(doc_id) AS keep_id, count(*) AS group_size FROM n GROUP BY t)
        SELECT n.doc_id, g.keep_id, g.group_size, n.doc_id = g.keep_id AS kept, sha256(n.t) AS text_sha256
        FROM n JOIN g USING (t)""",
}
