"""The operators applied to their whole tables, and the SQL that must give the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tidemark.llm import (
    bpe, exact_dedup, jaccard_join, licenses, line_dedup, lm_scores, mixing, order_minhash, phrases, quality, spelling,
    token_counts, toxicity,
)
from tidemark.llm.common import read

#: Name of a tokenizer file to its path; a parameter, so another installation can give another one.
PIECES, WORDS = "piece_bpe_32k.model", "word_bpe_49k.json"


def tokenizer(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.token_counts(read(spark, sf_dir, "documents"), tokenizer(PIECES))


def op2_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(read(spark, sf_dir, "documents")).drop("copies")


def op3_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.line_report(read(spark, sf_dir, "documents"))


def op4_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.encode(read(spark, sf_dir, "documents"), tokenizer(WORDS), ("n_tokens", "ids_sha256", "decoded_sha256"))


def op5_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality_report(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


def op6_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.license_report(read(spark, sf_dir, "documents"))


def op7_lm_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm_scores.score_report(read(spark, sf_dir, "documents"))


def op8_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.components_report(read(spark, sf_dir, "documents"))


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity_report(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


def op10_order_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return order_minhash.order_minhash(read(spark, sf_dir, "documents"))


def op11_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.copies(read(spark, sf_dir, "documents"))


def op12_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.spelling_variants(read(spark, sf_dir, "documents"))


def op13_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrases.collocations(read(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_token_counts, op2_mixing, op3_line_dedup, op4_bpe, op5_quality, op6_licenses, op7_lm_scores,
        op8_jaccard_join, op9_toxicity, op10_order_minhash, op11_exact_dedup, op12_spelling, op13_phrases,
    )
}

ORACLE: dict[str, str] = {
    "op2_mixing": mixing.ORACLE,
    "op3_line_dedup": line_dedup.ORACLE,
    "op7_lm_scores": lm_scores.ORACLE,
    "op8_jaccard_join": jaccard_join.ORACLE,
    "op11_exact_dedup": exact_dedup.ORACLE,
    "op13_phrases": phrases.ORACLE,
}
