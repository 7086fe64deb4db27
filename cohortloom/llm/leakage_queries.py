"""Problem 6: documents that hold passages of held-out test items."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from .leakage import leaks


def p6_leaks(spark: SparkSession, sf: str, slop: int | None = None) -> DataFrame:
    """Exact phrase matches with the length of the longest run."""
    docs, items = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/eval_items.parquet")
    return leaks(docs, "doc_id", "text", items, "item_id", "text", slop=slop)


def p6_found(spark: SparkSession, sf: str) -> DataFrame:
    """Documents with at least 13 consecutive words of an item."""
    return p6_leaks(spark, sf).select("doc_id", "item_id")


def p6_near(spark: SparkSession, sf: str) -> DataFrame:
    """Phrase matches and proximity matches: most words of a window within three words of their places."""
    return p6_leaks(spark, sf, slop=3)


QUERIES = {"p6_found": p6_found, "p6_near": p6_near}

#: The same cases by brute force: all windows of 13 words of both sides, joined.
ORACLE_SQL = {
    "p6_found": """
with d as (select doc_id, regexp_extract_all(lower(text), '[a-z0-9]+') as w from documents where text is not null),
i as (select item_id, regexp_extract_all(lower(text), '[a-z0-9]+') as w from eval_items where text is not null),
dw as (select doc_id, array_to_string(w[k : k + 12], ' ') as g from (select doc_id, w, unnest(range(1, len(w) - 11)) as k from d)),
iw as (select item_id, array_to_string(w[k : k + 12], ' ') as g from (select item_id, w, unnest(range(1, len(w) - 11)) as k from i))
select distinct doc_id, item_id from dw join iw using (g)
"""
}
