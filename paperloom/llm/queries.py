"""Queries of the text problems, with their SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ..session import table
from .language import detect_languages, language_cases, language_spans
from .leakage import leaked_items
from .lookalike import consistent, learn_scripts, same_looking_labels
from .quality import page_statistics
from .scannoise import paragraphs, scan_noise
from .tokenize import token_ids
from .truncation import truncated, truncation_shares


def p1_found(spark: SparkSession, d: str) -> DataFrame:
    return same_looking_labels(table(spark, d, "ocr_words"), table(spark, d, "recognition_labels"))


def p1_forms(spark: SparkSession, d: str) -> DataFrame:
    """Every value in its consistent form."""
    words = table(spark, d, "ocr_words")
    return consistent(words.select("word_id", "value").distinct(), {"value": "form"}, learn_scripts(words, "value"))


def p2_found(spark: SparkSession, d: str) -> DataFrame:
    return language_cases(table(spark, d, "ocr_words"), table(spark, d, "ocr_pages"))


def p2_pages(spark: SparkSession, d: str) -> DataFrame:
    """Language and confidence of every page."""
    return detect_languages(table(spark, d, "ocr_words"), table(spark, d, "ocr_pages"))[0]


def p2_spans(spark: SparkSession, d: str) -> DataFrame:
    """Stretches of one language inside blocks, with confidence."""
    return language_spans(table(spark, d, "ocr_words"), table(spark, d, "ocr_pages"))


def p3_found(spark: SparkSession, d: str) -> DataFrame:
    return page_statistics(table(spark, d, "ocr_words")).filter("kind != 'prose'").select("page_id", "kind")


def p3_statistics(spark: SparkSession, d: str) -> DataFrame:
    return page_statistics(table(spark, d, "ocr_words"))


def p5_found(spark: SparkSession, d: str) -> DataFrame:
    return scan_noise(table(spark, d, "ocr_words"), table(spark, d, "ocr_pages")).select("word_id", "kind")


def p5_paragraphs(spark: SparkSession, d: str) -> DataFrame:
    """Blocks of pages as continuous text."""
    return paragraphs(table(spark, d, "ocr_words"), table(spark, d, "ocr_pages"))


def p6_ids(spark: SparkSession, d: str) -> DataFrame:
    return token_ids(table(spark, d, "documents"))


def p7_found(spark: SparkSession, d: str) -> DataFrame:
    return leaked_items(table(spark, d, "documents"), table(spark, d, "eval_items"))


def p8_found(spark: SparkSession, d: str) -> DataFrame:
    return truncated(table(spark, d, "documents")).filter("cut").select("doc_id").distinct()


def p8_shares(spark: SparkSession, d: str) -> DataFrame:
    """How often each source truncates."""
    return truncation_shares(table(spark, d, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {f.__name__: f for f in (p1_found, p1_forms, p2_found, p2_pages, p2_spans, p3_found, p3_statistics, p5_found, p5_paragraphs, p6_ids, p7_found, p8_found, p8_shares)}
SQL: dict[str, str] = {}
