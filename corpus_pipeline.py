"""Corpus pipeline: stages over ``documents``, each written as Parquet before the next reads it.

Quality rules, exact dedup, near-duplicate dedup, mixing, tokenisation.  Each
stage works on all rows that the one before kept and returns the columns of
``documents``; the last returns piece ids.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from loam.llm.common import stage, table
from loam.llm.exact_dedup import drop_exact_duplicates
from loam.llm.mixing import mixed_documents
from loam.llm.ngram_join import drop_near_duplicates
from loam.llm.quality_rules import keep_quality
from loam.llm.sentencepiece_codec import encode


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that a base rule or the classifier rejects go."""
    return keep_quality(docs, table(spark, sf_dir, "labels"))


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts one row stays, of the largest doc_id."""
    return drop_exact_duplicates(docs, single=True)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each class of near duplicates (five-word shingles, Jaccard 0.8 or more, links followed) the smallest doc_id stays."""
    return drop_near_duplicates(docs, size=5, percent=80)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources mixed to their target weights: documents repeated as often as the mix takes them."""
    return mixed_documents(docs)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Piece ids of every document of the mix: ``doc_id, ids, n_ids``."""
    return encode(docs)


STAGES = [
    ("quality_rules", quality),
    ("exact_dedup", exact),
    ("ngram_jaccard_join", near),
    ("mix_sources", mix),
    ("sentencepiece", tokens),
]

#: No SQL: the quality stage learns a model; tests/llm holds each stage against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, function in STAGES:
        docs = stage(function(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
