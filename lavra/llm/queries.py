"""The operators' registered queries, each over its whole table, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

import corpus_pipeline
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lavra.llm import piece_codec
from lavra.llm.common import table
from lavra.llm.fingerprints import compare_edited, fit_ranks
from lavra.llm.jaccard_join import jaccard_components
from lavra.llm.line_dedup import dedup_lines
from lavra.llm.mixing import mix
from lavra.llm.ngram_lm import classify
from lavra.llm.oracle import SQL
from lavra.llm.quality_rules import quality_rules
from lavra.llm.secret_scan import secret_scan, spans_text
from lavra.llm.simhash_join import hex_digits, simhash_components
from lavra.llm.spelling_variants import spelling_variants
from lavra.llm.token_alignment import align_and_score
from lavra.llm.token_counts import count_tokens, read_ranks
from lavra.llm.url_filters import judge_urls

BASE_KINDS = ("assign", "access", "hex")


def op1_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = quality_rules(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return judged.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                         "base_failed", "kept", "stratum", "rejected_by")


def op2_document_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return compare_edited(docs, fit_ranks(docs))


def op3_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    counted = count_tokens(table(spark, sf_dir, "documents"), read_ranks())
    return counted.select("doc_id", "section", "start", "end", F.col("n_tokens").cast("long").alias("n_tokens"),
                          "n_crossing")


def op4_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge_urls(table(spark, sf_dir, "pages"))


def op5_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return judged.select("doc_id", "stratum", "n_symbols", "perplexity", "limit", "kept")


def op6_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = dedup_lines(table(spark, sf_dir, "documents"))
    return out.select("doc_id", F.col("text"), F.col("_lr_n_deleted").alias("n_lines_deleted"))


def op7_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_components(table(spark, sf_dir, "documents")).select("doc_id", "n_shingles", "component_id")


def op8_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    data = piece_codec.read_model()
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    coded = piece_codec.decode(piece_codec.encode(docs, data), data)
    return coded.select("doc_id", F.size("token_ids").alias("n_tokens"), "token_ids",
                        F.col("decoded").eqNullSafe(F.col("text")).alias("round_trip"))


def op9_secret_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    found, _ = secret_scan(table(spark, sf_dir, "documents"))

    def count(kind: str):
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long")

    return found.select(
        F.col("path").alias("doc_id"), *[count(k).alias(f"n_{k}") for k in BASE_KINDS],
        F.sha2(spans_text(F.col("spans"), BASE_KINDS), 256).alias("base_sha256"),
        spans_text(F.col("spans")).alias("spans"))


def op10_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix(table(spark, sf_dir, "documents")).select(
        "doc_id", "source", "tokens", "weight", "copy", "block", "place")


def op11_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return align_and_score(table(spark, sf_dir, "documents"))


def op12_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling_variants(table(spark, sf_dir, "documents"))


def op13_simhash_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash_components(table(spark, sf_dir, "documents"))
    return found.select("doc_id", hex_digits(F.col("fp")).alias("fingerprint"), "component_id")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (
        op1_quality_rules, op2_document_fingerprints, op3_token_counts, op4_url_filters, op5_quality_classifier,
        op6_line_dedup, op7_jaccard_join, op8_sentencepiece, op9_secret_scans, op10_mixing, op11_token_alignment,
        op12_spelling_variants, op13_simhash_join)}
QUERIES["pipeline"] = corpus_pipeline.run

__all__ = ["QUERIES", "SQL"]
