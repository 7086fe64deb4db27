"""Problem 1: nested stage-1 facts to related flat tables."""

from __future__ import annotations

from functools import cache

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..contracts import FACT_SIGNATURE, fact_schema
from ..operators.inlining import ElementGraph, infer_graph, relation_table, shred


@cache
def fact_graph() -> ElementGraph:
    return ElementGraph.from_struct("fact", fact_schema())


def _read(spark: SparkSession, sf: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/fact_records.parquet").select("fact_id", "raw_output")


def p1_found(spark: SparkSession, sf: str) -> DataFrame:
    """One row for each element of the four lists of each fact; see ``shred`` for nulls, bare values and broken texts."""
    lists = {"engineered_modifications", "perturbations", "ambiguity_flags", "targets"}
    rows = shred(_read(spark, sf), "fact_id", "raw_output", fact_graph(), FACT_SIGNATURE, only=lists)
    f = F.col("fields")
    value = (
        F.when(F.col("relation") == "perturbations", f["agent_normalized.id"])
        .when(F.col("relation") == "engineered_modifications", F.coalesce(f["kind"], f["value"]))
        .otherwise(f["value"])
    )
    return rows.select(
        "fact_id",
        F.col("relation").alias("list_name"),
        F.when(F.col("relation") == "targets", F.col("parent_ordinal")).otherwise(F.lit(-1)).alias("parent_index"),
        F.col("ordinal").alias("item_index"),
        F.coalesce(value, F.lit("")).alias("item_value"),
    )


def _table(relation: str):
    def query(spark: SparkSession, sf: str) -> DataFrame:
        rows = shred(_read(spark, sf), "fact_id", "raw_output", fact_graph(), FACT_SIGNATURE, only={relation})
        return relation_table(rows, "fact_id", fact_graph(), relation)

    query.__doc__ = f"The flat table of ``{relation}`` with its key and its foreign key."
    return query


def p1_schema(spark: SparkSession, sf: str) -> DataFrame:
    """The relations that the analysis of the records' own element graph yields, with their inlined columns."""
    graph = infer_graph(_read(spark, sf), "raw_output", FACT_SIGNATURE, root="fact")
    rows = [(r, c) for r in graph.all_relations() for c in (graph.columns(r) or [None])]
    return spark.createDataFrame(rows, "relation string, column_name string")


QUERIES = {
    "p1_found": p1_found,
    "p1_facts": _table("fact"),
    "p1_modifications": _table("engineered_modifications"),
    "p1_perturbations": _table("perturbations"),
    "p1_targets": _table("targets"),
    "p1_flags": _table("ambiguity_flags"),
    "p1_schema": p1_schema,
}
