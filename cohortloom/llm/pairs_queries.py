"""Problem 5: defective calls and their defect."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .pairs import broken_pairs


def p5_found(spark: SparkSession, sf: str) -> DataFrame:
    """One row for each defective call."""
    return broken_pairs(spark.read.parquet(f"{sf}/resolver_calls.parquet"), "call_id", "prompt", "reasoning")


def p5_summary(spark: SparkSession, sf: str) -> DataFrame:
    """Defects by model and kind, with the mean of the recorded output tokens."""
    calls = spark.read.parquet(f"{sf}/resolver_calls.parquet").select("call_id", "model_name", "output_tokens")
    found = p5_found(spark, sf)
    return calls.join(found, "call_id", "left").groupBy("model_name", F.coalesce("defect", F.lit("none")).alias("defect")).agg(F.count("*").alias("n_calls"), F.avg("output_tokens").alias("mean_output_tokens"))


QUERIES = {"p5_found": p5_found, "p5_summary": p5_summary}
