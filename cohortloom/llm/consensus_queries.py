"""Problem 2: one label and agreement per case, one reliability per annotator."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .consensus import consensus

LABELS = ["A", "B", "both", "unclear"]


def all_votes(spark: SparkSession, sf: str) -> DataFrame:
    """Votes of the two models and of the further annotators in one table."""
    cases = spark.read.parquet(f"{sf}/resolver_cases.parquet")
    votes = spark.read.parquet(f"{sf}/resolver_votes.parquet").select(
        F.col("case_id").alias("item"), "annotator", "choice", F.col("voted_at").cast("timestamp_ntz").alias("at"), "vote_id"
    )
    models = [
        cases.select(F.col("case_id").alias("item"), F.lit(f"model:{m}").alias("annotator"), F.col(f"{m}_choice").alias("choice"), F.col("asked_at").cast("timestamp_ntz").alias("at"), F.col("case_id").alias("vote_id"))
        for m in ("claude", "gpt")
    ]
    return votes.unionByName(models[0]).unionByName(models[1])


def p2_found(spark: SparkSession, sf: str) -> DataFrame:
    """The consensus label of every case with a valid vote."""
    return consensus(all_votes(spark, sf), LABELS)[0].select(F.col("item").alias("case_id"), "choice")


def p2_cases(spark: SparkSession, sf: str) -> DataFrame:
    """Label, posterior, agreement and number of votes per case."""
    return consensus(all_votes(spark, sf), LABELS)[0].withColumnRenamed("item", "case_id")


def p2_annotators(spark: SparkSession, sf: str) -> DataFrame:
    """Reliability and guess distribution of each annotator."""
    return consensus(all_votes(spark, sf), LABELS)[1]


QUERIES = {"p2_found": p2_found, "p2_cases": p2_cases, "p2_annotators": p2_annotators}
