"""Chunks, shards and nested inputs of batch runs."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import token_estimate
from ..workspace import materialize
from .prefix import running_sum
from .sampling import shuffled_rank


def chunk_groups(df: DataFrame, group: str, id_col: str, size: int = 50, seed: int = 42) -> DataFrame:
    """Adds rank and chunk (from 0) of each row in its group's shuffled order."""
    return shuffled_rank(df, group, id_col, seed).withColumn("chunk", F.floor(F.col("rank") / size))


def nested_chunks(df: DataFrame, group: str, id_col: str, payload: list[str], size: int = 50, seed: int = 42) -> DataFrame:
    """One row per (group, chunk) with its rows as an array in shuffled order and the chunk's metadata.

    Arrays hold at most ``size`` rows, so groups of any size stay within bounds.
    """
    c = chunk_groups(df, group, id_col, size, seed)
    rows = F.transform(F.sort_array(F.collect_list(F.struct("rank", *payload))), lambda x: F.struct(*[x[p].alias(p) for p in payload]))
    chunks = c.groupBy(group, "chunk").agg(rows.alias("samples"), F.count("*").alias("n_samples"))
    totals = c.groupBy(group).agg(F.count("*").alias("study_total"), (F.max("chunk") + 1).alias("total_parts"))
    out = chunks.join(totals, group)
    record = F.when(F.col("total_parts") > 1, F.concat(F.col(group), F.lit("#"), (F.col("chunk") + 1).cast("string"))).otherwise(F.col(group))
    return out.select(record.alias("record_id"), group, F.struct((F.col("chunk") + 1).alias("part"), "total_parts", F.col("study_total").alias("study_total_samples"), F.col(group).alias("original_record_key")).alias("chunk_metadata"), "samples", "n_samples")


def rechunk(df: DataFrame, record: str, samples: str, size: int = 25) -> DataFrame:
    """Existing nested arrays cut into parts of ``size`` with ids ``--rsc{k}of{n}``; empty arrays give no part."""
    n = F.ceil(F.size(samples) / size).cast("int")
    parts = df.filter(F.size(samples) > 0).select("*", n.alias("_n"), F.explode(F.sequence(F.lit(1), n)).alias("_k"))
    return parts.withColumn(record, F.concat(F.col(record), F.lit("--rsc"), "_k", F.lit("of"), "_n")).withColumn(samples, F.slice(samples, (F.col("_k") - 1) * size + 1, F.lit(size))).drop("_n", "_k")


def round_robin(df: DataFrame, order: str, shards: int, bucket_rows: int = 100_000) -> DataFrame:
    """Adds ``shard``: rank by an order column, modulo the number of shards.

    Ranks are taken in two levels over range partitions of about ``bucket_rows`` rows, however sparse the column is; the
    cut is written once, so that the partitions stay the same. Equal values are ordered by the row's hash; nulls come first.
    """
    parts = max(1, -(-df.count() // bucket_rows))
    whole = F.xxhash64(*df.columns)
    cut = materialize(df.withColumn("_h", whole).repartitionByRange(parts, order, "_h").withColumn("_bucket_id", F.spark_partition_id()), "ranges").withColumn("_g", F.lit(0))
    ranked = running_sum(cut, "_g", F.col("_bucket_id"), [order, "_h"], F.lit(1).cast("long"), "_r").drop("_h", "_bucket_id")
    return ranked.withColumn("shard", (F.col("_r") % shards).cast("int")).drop("_g", "_r")


def greedy_chunks(df: DataFrame, group: str, order: str, text: str, context_tokens: int, prompt_tokens: int, reserve: int, fraction: float = 0.70, max_records: int = 1_000_000, max_group_rows: int = 5_000_000) -> DataFrame:
    """Greedy token-budget chunks of each group, in order: group, chunk_id, start_index, end_index (from 1), record_count, estimated_tokens, oversize.

    A chunk starts at the prompt's tokens and takes records while tokens and count fit; a record that fits no
    chunk forms one of its own. The fold over a group is sequential by nature, so a group is one file of at most
    ``max_group_rows`` records, and a larger one raises an error; it carries two numbers a record, never the texts. Null texts count one token.
    """
    import math

    budget = math.floor(context_tokens * fraction)
    costs = df.select(group, F.col(order).alias("_o"), (token_estimate(F.col(text)) + reserve).alias("_cost"))

    def fold(pdf):
        import pandas as pd

        if len(pdf) > max_group_rows:
            raise ValueError(f"group {pdf[group].iloc[0]} has {len(pdf)} rows, more than {max_group_rows}")
        pdf = pdf.sort_values("_o", kind="stable")
        rows, start, total, count = [], 1, prompt_tokens, 0
        for i, cost in enumerate(pdf["_cost"], 1):
            if count and (total + cost > budget or count + 1 > max_records):
                rows.append((start, i - 1, count, total, False))
                start, total, count = i, prompt_tokens, 0
            if not count and total + cost > budget:
                rows.append((i, i, 1, total + cost, True))
                start, total, count = i + 1, prompt_tokens, 0
                continue
            total, count = total + cost, count + 1
        if count:
            rows.append((start, start + count - 1, count, total, False))
        out = pd.DataFrame(rows, columns=["start_index", "end_index", "record_count", "estimated_tokens", "oversize"])
        out.insert(0, "chunk_id", range(1, len(out) + 1))
        out.insert(0, group, pdf[group].iloc[0])
        return out

    kind = df.schema[group].dataType.simpleString()
    return costs.filter(F.col(group).isNotNull()).groupBy(group).applyInPandas(fold, f"{group} {kind}, chunk_id long, start_index long, end_index long, record_count long, estimated_tokens long, oversize boolean")
