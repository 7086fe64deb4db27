"""Problem 8: spam among the documents."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from .stuffing import stuffed_pages


def p8_pages(spark: SparkSession, sf: str) -> DataFrame:
    """Spam pages with their share of stuffed words and the dominance of their commonest shapes."""
    return stuffed_pages(spark.read.parquet(f"{sf}/documents.parquet"), "doc_id", "text")


def p8_found(spark: SparkSession, sf: str) -> DataFrame:
    """The doc_ids of spam pages."""
    return p8_pages(spark, sf).select("doc_id")


QUERIES = {"p8_found": p8_found, "p8_pages": p8_pages}
