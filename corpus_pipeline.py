"""A training corpus from raw documents, in five stages.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is
written as Parquet and read again as the next stage's docs. All but the last
return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lavra.llm import piece_codec
from lavra.llm.common import store, table
from lavra.llm.jaccard_join import keep_one
from lavra.llm.line_dedup import dedup_lines
from lavra.llm.mixing import mix_documents
from lavra.llm.ngram_lm import keep_quality


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose n-gram perplexity fits their language's trusted text."""
    return keep_quality(docs, table(spark, sf_dir, "labels"))


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Later copies of repeated line runs deleted; documents left without a worded line go."""
    return dedup_lines(docs, drop_emptied=True).select(*[F.col(f"`{c}`") for c in docs.columns])


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates."""
    return keep_one(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document at least once; those of sources that gain weight come again."""
    return mix_documents(docs)


def encode_pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, source, lang, n_tokens and token_ids of every document that the mixture emits."""
    coded = piece_codec.encode(docs.select("doc_id", "source", "lang", "text"), piece_codec.read_model())
    return coded.select("doc_id", "source", "lang", F.size("token_ids").alias("n_tokens"), "token_ids")


STAGES = [
    ("quality classifier", quality_classifier),
    ("line dedup", line_dedup),
    ("n-gram Jaccard join", near_duplicates),
    ("mixing sources to target weights", mix_sources),
    ("SentencePiece encoding", encode_pieces),
]

ORACLE_SQL = None  # perplexities, components and piece ids can't be written in SQL; tests hold them to brute force


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = store(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
