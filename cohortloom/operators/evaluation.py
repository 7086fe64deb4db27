"""Evaluation: confusion metrics, intervals, paired tests, adjusted p-values, agreement."""

from __future__ import annotations

import math
from statistics import NormalDist

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T


def wilson(successes: Column, n: Column, confidence: float = 0.95) -> tuple[Column, Column]:
    """(low, high) of the Wilson interval, clamped to [0, 1]; null for n = 0."""
    z = NormalDist().inv_cdf(0.5 + confidence / 2)
    n = n.cast("double")
    p = F.try_divide(successes, n)
    centre = p + z * z / (2 * n)
    half = F.lit(z) * F.sqrt(p * (1 - p) / n + z * z / (4 * n * n))
    scale = 1 + z * z / n
    return F.when(n > 0, F.greatest(F.lit(0.0), (centre - half) / scale)), F.when(n > 0, F.least(F.lit(1.0), (centre + half) / scale))


def binary_metrics(df: DataFrame, gold: str, predicted: str, *groups: str) -> DataFrame:
    """Confusion counts and accuracy, sensitivity, specificity, f1 per group; rows with a null side don't count.

    Null group keys form their own group; a metric whose denominator is 0 is null; without groups an empty
    table gives one row with n = 0.
    """
    g, p = F.col(gold), F.col(predicted)
    count = lambda a, b: F.count_if((g == a) & (p == b))
    out = df.dropna(subset=[gold, predicted]).groupBy(*groups).agg(
        count("treated", "treated").alias("tp"), count("control", "control").alias("tn"), count("control", "treated").alias("fp"), count("treated", "control").alias("fn")
    )
    tp, tn, fp, fn = (F.col(c) for c in ("tp", "tn", "fp", "fn"))
    n = tp + tn + fp + fn
    return out.select(
        *groups, "tp", "tn", "fp", "fn", n.alias("n"), F.try_divide(tp + tn, n).alias("accuracy"), F.try_divide(tp, tp + fn).alias("sensitivity"),
        F.try_divide(tn, tn + fp).alias("specificity"), F.try_divide(2 * tp, 2 * tp + fp + fn).alias("f1"),
    )


def validity_rate(df: DataFrame, valid: str) -> DataFrame:
    """One row: rows and the share that is valid, unknown counting as not; no rows raise an error when the result is read."""
    n = F.count("*")
    rate = F.round(F.avg(F.coalesce(F.col(valid), F.lit(False)).cast("double")), 6)
    return df.agg(n.alias("n"), F.when(n == 0, F.raise_error(F.lit("no rows to rate")).cast("double")).otherwise(rate).alias("rate"))


def confusion(df: DataFrame, gold: str, predicted: str, levels: list[str]) -> DataFrame:
    """Counts of all level pairs, zero counts included."""
    spark = df.sparkSession
    grid = spark.createDataFrame([(a, b) for a in levels for b in levels], "gold string, predicted string")
    counts = df.groupBy(F.col(gold).alias("gold"), F.col(predicted).alias("predicted")).agg(F.count("*").alias("n"))
    return F.broadcast(grid).join(counts, ["gold", "predicted"], "left").select("gold", "predicted", F.coalesce("n", F.lit(0)).alias("n"))


@F.pandas_udf(T.DoubleType())
def chi_square_tail(x: pd.Series) -> pd.Series:
    """Upper tail of chi-square with one degree of freedom, on already aggregated rows."""
    return x.map(lambda v: math.erfc(math.sqrt(v / 2)) if v == v and v is not None else None)


def mcnemar(df: DataFrame, right_a: str, right_b: str, *groups: str, continuity: bool = False) -> DataFrame:
    """b, c, chi-square and p of two models' paired correctness; null where b + c = 0."""
    a, b = F.col(right_a), F.col(right_b)
    out = df.dropna(subset=[right_a, right_b]).groupBy(*groups).agg(F.count_if(a & ~b).alias("b"), F.count_if(~a & b).alias("c"))
    d = F.abs(F.col("b") - F.col("c")) - (1 if continuity else 0)
    chi = F.when(F.col("b") + F.col("c") > 0, F.pow(F.greatest(d, F.lit(0)), F.lit(2)) / (F.col("b") + F.col("c")))
    return out.withColumn("chi_square", chi).withColumn("p_value", chi_square_tail(F.col("chi_square")))


def bootstrap_delta(df: DataFrame, right_a: str, right_b: str, iterations: int = 1000, seed: int = 42, confidence: float = 0.95) -> DataFrame:
    """Percentile interval of the accuracy difference of two models: n, delta, low, high.

    A row's difference is -1, 0 or 1, so resampling n rows with replacement is a multinomial draw from the three
    counts: one aggregation over the rows, then ``iterations`` draws, at any n. No rows give no row.
    """
    import numpy as np

    d = F.col(right_a).cast("int") - F.col(right_b).cast("int")
    counts = {r["_d"]: r["count"] for r in df.dropna(subset=[right_a, right_b]).groupBy(d.alias("_d")).count().collect()}
    n = sum(counts.values())
    spark = df.sparkSession
    schema = "n long, delta double, low double, high double"
    if not n:
        return spark.createDataFrame([], schema)
    shares = [counts.get(k, 0) / n for k in (-1, 0, 1)]
    drawn = np.random.default_rng(seed).multinomial(n, shares, size=iterations)
    deltas = (drawn[:, 2] - drawn[:, 0]) / n
    tail = (1 - confidence) / 2
    low, high = np.quantile(deltas, [tail, 1 - tail])
    return spark.createDataFrame([(n, shares[2] - shares[0], float(low), float(high))], schema)


def holm(df: DataFrame, p: str, *, order: list[str]) -> DataFrame:
    """Adds ``p_holm``: step-down adjusted p-values over a small result table; null p stays null and isn't counted."""
    m = Window.partitionBy()
    by_p = Window.orderBy(F.col(p).asc_nulls_last(), *order)
    factor = F.count(p).over(m) - F.row_number().over(by_p) + 1
    step = F.col(p) * factor
    out = df.withColumn("_step", step)
    run = F.max("_step").over(by_p.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    return out.withColumn("p_holm", F.when(F.col(p).isNotNull(), F.least(F.lit(1.0), run))).drop("_step")


def majority(df: DataFrame, group: list[str], value: str, name: str = "majority") -> DataFrame:
    """The commonest non-null value per group, ties by the smaller value; two aggregations, no window."""
    counts = df.filter(F.col(value).isNotNull()).groupBy(*group, value).agg(F.count("*").alias("_n"))
    return counts.groupBy(*group).agg(F.min(F.struct((-F.col("_n")).alias("n"), F.col(value).alias("v"))).alias("_m")).select(*group, F.col("_m.v").alias(name), (-F.col("_m.n")).alias("n_votes"))


def difficulty_tier(score: Column) -> Column:
    return F.when(score >= 0.60, "easy").when(score >= 0.45, "medium").when(score.isNotNull(), "hard")


def confidence_score(kind: Column, role: Column, anchor: Column) -> Column:
    """Weighted agreement of one pair of models; null role and anchor rates count as 0."""
    return 0.3 * kind + 0.5 * F.coalesce(role, F.lit(0.0)) + 0.2 * F.coalesce(anchor, F.lit(0.0))


def jaccard(a: Column, b: Column) -> Column:
    """Share of common elements of two sets; both empty gives 1."""
    union = F.size(F.array_union(a, b))
    return F.when(union == 0, F.lit(1.0)).otherwise(F.size(F.array_intersect(a, b)) / union)


def pairwise_role_agreement(labels: DataFrame, group: str, item: str, model: str, value: str) -> DataFrame:
    """Per group and pair of models: share of shared items with equal labels (two nulls are equal).

    Self-join on (group, item): an item has one row per model, so pairs stay bounded by the models.
    """
    a, b = labels.alias("a"), labels.alias("b")
    joined = a.join(b, (F.col(f"a.{group}") == F.col(f"b.{group}")) & (F.col(f"a.{item}") == F.col(f"b.{item}")) & (F.col(f"a.{model}") < F.col(f"b.{model}")))
    return joined.groupBy(F.col(f"a.{group}").alias(group), F.col(f"a.{model}").alias("model_a"), F.col(f"b.{model}").alias("model_b")).agg(
        F.avg((F.col(f"a.{value}").eqNullSafe(F.col(f"b.{value}"))).cast("double")).alias("role_match"), F.count("*").alias("n_shared")
    )
