"""Problem 7: the mixture of the documents' sources and its actual shares."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .mixing import mix


def _mix(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    return mix(spark.read.parquet(f"{sf}/documents.parquet"), "doc_id", "source", "text", spark.read.parquet(f"{sf}/mix_targets.parquet"))


def p7_mixture(spark: SparkSession, sf: str) -> DataFrame:
    """Slots of the mixture with the documents that fill them."""
    return _mix(spark, sf)[0]


def p7_shares(spark: SparkSession, sf: str) -> DataFrame:
    """Target and actual share of each source."""
    return _mix(spark, sf)[1]


def p7_properties(spark: SparkSession, sf: str) -> DataFrame:
    """What every mixture must keep, per target source: the cap on copies, the share within a hundredth, and blocks without gaps."""
    mixture, report = _mix(spark, sf)
    # the copies of a source's documents stand end to end from 0, so their tokens reach exactly as far as the last one
    reach = mixture.groupBy("source").agg(F.sum("tokens").alias("_sum"), F.max(F.col("place") + F.col("tokens")).alias("_end"), F.count_distinct("place").alias("_places"), F.count("*").alias("_n"))
    near = F.abs(F.col("actual_share") - F.col("target_share")) <= 0.01
    return report.join(reach, "source", "left").select("source", (F.col("most_copies") <= F.col("max_repeats")).alias("cap_kept"), near.alias("share_near"), ((F.col("_sum") == F.col("_end")) & (F.col("_places") == F.col("_n"))).alias("gapless"))


QUERIES = {"p7_properties": p7_properties, "p7_mixture": p7_mixture, "p7_shares": p7_shares}

#: The properties hold for every target source; token counts need the tokenizer and aren't in SQL.
ORACLE_SQL = {"p7_properties": "select source, true as cap_kept, true as share_near, true as gapless from mix_targets"}
