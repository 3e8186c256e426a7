"""One registered query per operator: the operator with production parameters over its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loam.llm.common import table
from loam.llm.exact_dedup import exact_dedup
from loam.llm.html_extract import extract_text
from loam.llm.lexical_search import lexical_search
from loam.llm.line_dedup import html_lines, line_dedup, url_host
from loam.llm.merkle_manifest import merkle_manifest
from loam.llm.mixing import mix_sources
from loam.llm.ngram_join import ngram_jaccard_join
from loam.llm.quality_classifier import quality_classifier
from loam.llm.quality_rules import quality_rules
from loam.llm.sentencepiece_codec import encode
from loam.llm.substring_dedup import substring_dedup
from loam.llm.suffix_dedup import suffix_dedup
from loam.llm.url_filter import url_filter


def op1_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"
    )


def op2_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Boilerplate lines of every page, by host."""
    pages = table(spark, sf_dir, "pages").select(
        "page_id", url_host(F.col("url")).alias("host"), html_lines(F.col("html")).alias("text")
    )
    return line_dedup(pages).select(
        "page_id", "host", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256")
    )


def op3_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_jaccard_join(table(spark, sf_dir, "documents"))


def op4_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter(table(spark, sf_dir, "pages")).select("page_id", "host", "path", "rule", "verdict", "score")


def op5_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "probability"
    )


def op6_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of every text, and a digest of the text that they decode to."""
    return encode(table(spark, sf_dir, "documents"), decoded=True).select(
        "doc_id", "n_ids", "ids", F.sha2("text", 256).alias("decoded_sha256")
    )


def op7_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup(table(spark, sf_dir, "documents"), digest=True)


def op8_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_classifier(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op9_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract_text(table(spark, sf_dir, "pages"))


def op10_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix_sources(table(spark, sf_dir, "documents")).select(
        "doc_id", "size", "source_size", "target", "taken"
    )


def op11_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every ``benchmark`` item as a query against all documents."""
    return lexical_search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op12_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup(table(spark, sf_dir, "documents"))


def op13_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle_manifest(table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_suffix_dedup": op1_suffix_dedup,
    "op2_line_dedup": op2_line_dedup,
    "op3_ngram_jaccard": op3_ngram_jaccard,
    "op4_url_filters": op4_url_filters,
    "op5_quality_rules": op5_quality_rules,
    "op6_sentencepiece": op6_sentencepiece,
    "op7_exact_dedup": op7_exact_dedup,
    "op8_quality_classifier": op8_quality_classifier,
    "op9_html_extraction": op9_html_extraction,
    "op10_mix_sources": op10_mix_sources,
    "op11_lexical_search": op11_lexical_search,
    "op12_substring_dedup": op12_substring_dedup,
    "op13_merkle_manifest": op13_merkle_manifest,
}
