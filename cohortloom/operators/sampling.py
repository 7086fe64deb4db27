"""Deterministic sampling, shuffling and interleaving by the hash of (seed, id)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .prefix import running_sum


def hash_order(seed: int, id_col: str) -> Column:
    return F.sha2(F.concat(F.lit(f"{seed}:"), F.col(id_col).cast("string")), 256)


def shuffled_rank(df: DataFrame, group: str, id_col: str, seed: int, name: str = "rank", bucket_digits: int = 2) -> DataFrame:
    """Adds the rank, from 0, of each row in its group's shuffled order.

    Ranks are taken within hash-prefix buckets and offset by the buckets' counts, so a group that holds a third
    of all rows is spread over 16**bucket_digits tasks.
    """
    h = df.withColumn("_h", hash_order(seed, id_col))
    return running_sum(h, group, F.substring("_h", 1, bucket_digits), ["_h", id_col], F.lit(1).cast("long"), name).drop("_h")


def top_by_hash(df: DataFrame, n: int, id_col: str, seed: int) -> DataFrame:
    """n rows of the whole table: a top-k without a global sort."""
    return df.withColumn("_h", hash_order(seed, id_col)).orderBy("_h", id_col).limit(n).drop("_h")


def stratified(df: DataFrame, stratum: str, targets: dict[str, int], id_col: str, seed: int, fallback: str | None = None) -> DataFrame:
    """Rows up to the target of each stratum; what strata lack is filled from ``fallback`` as far as it goes.

    Every task keeps at most the needed rows of a stratum (rank filter pushed below the window by the engine),
    strata without a target are left out.
    """
    keys = list(targets)
    pool = df.filter(F.col(stratum).isin(keys))
    w = Window.partitionBy(stratum).orderBy(hash_order(seed, id_col), id_col)
    sizes = {r[stratum]: r["count"] for r in pool.groupBy(stratum).count().collect()}
    wanted = dict(targets)
    if fallback:
        lack = sum(max(0, t - sizes.get(k, 0)) for k, t in targets.items() if k != fallback)
        wanted[fallback] = targets[fallback] + lack
    limit = F.create_map(*[x for k, t in wanted.items() for x in (F.lit(k), F.lit(t))])[F.col(stratum)]
    return pool.withColumn("_r", F.row_number().over(w)).filter(F.col("_r") <= max(wanted.values())).filter(F.col("_r") <= limit).drop("_r")


def require_unique(df: DataFrame, key: str) -> DataFrame:
    """``df``, or an error that names a key which occurs twice."""
    twice = df.groupBy(key).count().filter("count > 1").first()
    if twice is not None:
        raise ValueError(f"{key} {twice[0]} occurs {twice['count']} times")
    return df


def require_rows(df: DataFrame, least: int, name: str) -> DataFrame:
    """``df``, or an error if it has fewer than ``least`` rows; no more than ``least`` are counted."""
    n = df.limit(least).count()
    if n < least:
        raise ValueError(f"{name}: {n} rows, fewer than {least}")
    return df


def quota_sample(df: DataFrame, pinned: Column, stratum: str, quotas: dict[str, int], total: int, id_col: str, seed: int) -> DataFrame:
    """``total`` rows: the pinned ones, then the first of each stratum by hash up to its quota, then the rest by hash; ``step`` tells which (0, 1, 2).

    No stratum is ordered as a whole: only the first rows of each step by hash are taken. Strata without a quota fill up.
    """
    pin = F.coalesce(pinned, F.lit(False))
    marked = df.withColumn("_pin", pin).withColumn("_h", hash_order(seed, id_col))
    parts = [marked.filter("_pin").withColumn("step", F.lit(0)).orderBy("_h", id_col).limit(total)]
    for k, n in quotas.items():
        parts.append(marked.filter(~F.col("_pin") & (F.col(stratum) == k)).withColumn("step", F.lit(1)).orderBy("_h", id_col).limit(n))
    chosen = parts[0]
    for p in parts[1:]:
        chosen = chosen.unionByName(p)
    # the first ``total`` rows of the rest lie among the first total + chosen rows of all
    most = total + sum(quotas.values())
    rest = marked.filter("not _pin").withColumn("step", F.lit(2)).orderBy("_h", id_col).limit(most).join(chosen.select(id_col), id_col, "left_anti")
    return chosen.unionByName(rest.select(*chosen.columns)).orderBy("step", "_h", id_col).limit(total).drop("_h", "_pin")


def quartile_strata(df: DataFrame, value: str, name: str = "quartile") -> DataFrame:
    """Q1 to Q4 by right-closed quartile cuts with the minimum in Q1; null stays null."""
    cuts = df.agg(F.percentile(value, F.array(F.lit(0.25), F.lit(0.5), F.lit(0.75))).alias("_c"))
    x, c = F.col(value), F.col("_c")
    return df.crossJoin(F.broadcast(cuts)).withColumn(name, F.when(x <= c[0], "Q1").when(x <= c[1], "Q2").when(x <= c[2], "Q3").when(x.isNotNull(), "Q4")).drop("_c")


def interleave(df: DataFrame, stratum: str, weights: dict[str, int], id_col: str, seed: int) -> DataFrame:
    """Adds ``cycle`` and the stratum's ordinal: reading by (cycle, ordinal, rank) mixes strata by their weights."""
    ranked = shuffled_rank(df.filter(F.col(stratum).isin(list(weights))), stratum, id_col, seed)
    w = F.create_map(*[x for k, v in weights.items() for x in (F.lit(k), F.lit(v))])[F.col(stratum)]
    o = F.create_map(*[x for i, k in enumerate(weights) for x in (F.lit(k), F.lit(i))])[F.col(stratum)]
    return ranked.withColumn("cycle", F.floor(F.col("rank") / w)).withColumn("stratum_order", o)
