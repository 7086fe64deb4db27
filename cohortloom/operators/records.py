"""Choosing, merging and looking up records."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def pick(df: DataFrame, key: list[str], order: list[Column], last: bool = False) -> DataFrame:
    """One row per key: the first (or last) by ``order``. An aggregation with map-side combine, so hot keys are reduced before the shuffle; null keys form one group."""
    rest = [c for c in df.columns if c not in key]
    rank = F.struct(*[o.alias(f"o{i}") for i, o in enumerate(order)], *[F.col(c) for c in rest])
    best = (F.max if last else F.min)(rank).alias("_m")
    return df.groupBy(*key).agg(best).select(*key, *[F.col("_m")[c].alias(c) for c in rest]).select(*df.columns)


def overlay(base: DataFrame, patch: DataFrame, key: str, columns: list[str], tag: str) -> DataFrame:
    """``base`` with the columns of matching ``patch`` rows in place of its own, and ``source`` telling which."""
    p = patch.select(F.col(key).alias("_k"), *[F.col(c).alias(f"_p_{c}") for c in columns], F.lit(True).alias("_hit"))
    out = base.join(p, F.col(key) == F.col("_k"), "left")
    cols = [F.when(F.col("_hit"), F.col(f"_p_{c}")).otherwise(F.col(c)).alias(c) if c in columns else F.col(c) for c in base.columns]
    return out.select(*cols, F.when(F.col("_hit"), tag).otherwise("base").alias("source"))


def first_hit(needles: DataFrame, needle: str, dictionaries: list[DataFrame], max_broadcast_bytes: int = 32_000_000) -> DataFrame:
    """Cascade lookup: distinct needles with the entry of the first dictionary that has them.

    Each dictionary has ``name`` and ``entry`` (several entries for a name: the smaller). Dictionaries are
    cut into (name, priority, entry) and reduced to the first hit per name before the join; their bytes
    are summed up before they are broadcast. Null needles give no row.
    """
    long = reduce(DataFrame.unionByName, [d.select(F.lower("name").alias("_n"), F.lit(i).alias("priority"), F.col("entry").cast("string").alias("entry")) for i, d in enumerate(dictionaries)])
    best = long.filter(F.col("_n").isNotNull()).groupBy("_n").agg(F.min(F.struct("priority", "entry")).alias("m"))
    # the text of a row and 60 bytes around it
    size = long.agg(F.sum(F.octet_length("_n") + F.octet_length("entry") + 60)).first()[0] or 0
    small = size <= max_broadcast_bytes
    keys = needles.select(needle).filter(F.col(needle).isNotNull()).distinct()
    return keys.join(F.broadcast(best) if small else best, F.lower(needle) == F.col("_n"), "left").select(needle, "m.entry", F.col("m.priority").alias("resolved_via"))


def once_per_key(df: DataFrame, key: str, compute: dict[str, Column]) -> DataFrame:
    """Columns computed once per distinct key and joined back."""
    keys = df.select(key).distinct().select(key, *[c.alias(n) for n, c in compute.items()])
    return df.join(keys, df[key].eqNullSafe(keys[key]), "left").drop(keys[key])


def quarantine(df: DataFrame, group: str, bad: Column, least: int = 5, share: float = 0.5) -> DataFrame:
    """Groups with at least ``least`` bad rows that are at least ``share`` of theirs."""
    out = df.groupBy(group).agg(F.count_if(bad).alias("n_bad"), F.count("*").alias("n_rows"))
    return out.filter((F.col("n_bad") >= least) & (F.col("n_bad") >= share * F.col("n_rows")))


def split_validity(df: DataFrame, valid: Column) -> tuple[DataFrame, DataFrame]:
    """(valid, invalid); unknown counts as invalid."""
    ok = F.coalesce(valid, F.lit(False))
    return df.filter(ok), df.filter(~ok)


def priority_union(parts: list[tuple[str, int, DataFrame]], key: str) -> DataFrame:
    """Union by name with missing columns as null; the part with the highest priority wins a key."""
    tagged = [df.withColumn("source", F.lit(n)).withColumn("_priority", F.lit(p)) for n, p, df in parts]
    every = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), tagged)
    return pick(every, [key], [F.col("_priority"), F.col("source")], last=True).drop("_priority")


def siblings(failed: DataFrame, valid: DataFrame, text: str, id_col: str) -> DataFrame:
    """Failed rows with the id of a valid row whose input text is the same, byte for byte."""
    source = valid.filter(F.col(text).isNotNull()).groupBy(F.sha2(text, 256).alias("_h")).agg(F.min(id_col).alias("copied_from"))
    return failed.withColumn("_h", F.sha2(text, 256)).join(source, "_h").drop("_h")
