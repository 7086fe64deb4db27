"""Problem 4: free-entered cell and disease names to the reference list."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .canonical import map_columns

FIELDS = {"cell_type_or_line_raw": "cell", "cell_line_cellosaurus_candidate": "cell", "term_raw": "disease"}


def p4_matches(spark: SparkSession, sf: str) -> DataFrame:
    """Every non-null value with its entry, the distance and the key that it met."""
    df = spark.read.parquet(f"{sf}/cell_contexts.parquet").select("context_id", *FIELDS)
    return map_columns(df, "context_id", FIELDS, spark.read.parquet(f"{sf}/ref_terms.parquet"))


def p4_found(spark: SparkSession, sf: str) -> DataFrame:
    """The entry that each value names, or ``unmatched``."""
    return p4_matches(spark, sf).select("context_id", "field_name", F.coalesce("ref_id", F.lit("unmatched")).alias("ref_id"))


def p4_unmatched(spark: SparkSession, sf: str) -> DataFrame:
    """Report of the unmatched values with the number of rows that hold them."""
    return p4_matches(spark, sf).filter("ref_id is null").groupBy("field_name", "value").agg(F.count("*").alias("n_rows"))


QUERIES = {"p4_found": p4_found, "p4_matches": p4_matches, "p4_unmatched": p4_unmatched}
