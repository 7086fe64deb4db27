"""Mixing sources to target weights by a low-discrepancy source schedule.

Golden-ratio (or van der Corput) points run through the cumulative weights and name a source for each slot;
slots are ranked within their source, and the k-th slot of a source takes the k-th block of equal tokens of
that source's shuffled documents. A source shorter than its slots is repeated up to its cap. All running sums
and ranks are taken in two levels, so no source, however large, meets in one task.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import lru_cache

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.prefix import running_sum
from ..workspace import materialize, spread

GOLDEN = (math.sqrt(5) - 1) / 2


def default_vocabulary() -> str:
    import public_tokenizers

    return str(public_tokenizers.path("byte_bpe_50k.tiktoken"))


@lru_cache(maxsize=4)
def _encoding(path: str):
    import base64

    import public_tokenizers
    import tiktoken

    with open(path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def token_counts(df: DataFrame, id_col: str, text_col: str, vocabulary: str, *keep: str) -> DataFrame:
    """id, kept columns and ``tokens``, the number of tokens of the whole text; a null text has none."""

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        enc = _encoding(vocabulary)
        for b in batches:
            texts = [t if isinstance(t, str) else "" for t in b.pop("_text")]
            b["tokens"] = [len(x) for x in enc.encode_ordinary_batch(texts, num_threads=1)]
            yield b

    fields = [f"`{c}` {df.schema[c].dataType.simpleString()}" for c in (id_col, *keep)]
    return spread(df.select(id_col, *keep, F.col(text_col).alias("_text"))).mapInPandas(count, ", ".join([*fields, "tokens long"]))


def schedule(spark, shares: list[tuple[str, float]], slots: int, points: str = "golden", chunk: int = 100_000) -> DataFrame:
    """(slot, source, block): the source of each slot and the slot's rank among the slots of its source, from 0."""
    total = sum(w for _, w in shares)
    bounds, at = [], 0.0
    for _, w in shares[:-1]:
        at += w / total
        bounds.append(at)
    i = F.col("id")
    if points == "golden":
        x = (i + 0.5) * F.lit(GOLDEN)
        u = x - F.floor(x)
    else:
        u = F.conv(F.reverse(F.lpad(F.bin(i + 1), 48, "0")), 2, 10).cast("double") / F.lit(2.0**48)
    names = F.array(*[F.lit(s) for s, _ in shares])
    place = F.size(F.filter(F.array(*[F.lit(b) for b in bounds]).cast("array<double>"), lambda b: b <= F.col("u"))) if bounds else F.lit(0)
    rows = spark.range(slots).withColumn("u", u).select(i.alias("slot"), F.element_at(names, place + 1).alias("source"))
    return running_sum(rows, "source", F.floor(F.col("slot") / chunk), ["slot"], F.lit(1), "block")


def mix(docs: DataFrame, id_col: str, source_col: str, text_col: str, targets: DataFrame, total_tokens: int | None = None, block_tokens: int | None = None, seed: int = 1, points: str = "golden", vocabulary: str | None = None, max_sources: int = 5000, bucket_rows: int = 50_000) -> tuple[DataFrame, DataFrame]:
    """(mixture, report). ``targets``: source, target_share, max_repeats.

    mixture: slot, source, id, copy (from 0), tokens and place, the order within the slot. Without
    ``total_tokens`` the mixture is the largest in which every source can hold its share. Without ``block_tokens`` a block
    is a thousandth of the smallest source's part, 16 tokens at least and 1024 at most. report: one row per
    target source with its target and actual share, tokens, documents and most copies; a source without tokens
    holds 0 and leaves its share to the others. Null sources, sources without a target and documents without
    tokens take no part; an empty table gives an empty mixture.
    """
    spark = docs.sparkSession
    wanted = targets.filter(F.col("source").isNotNull()).orderBy("source").limit(max_sources + 1).collect()
    if len(wanted) > max_sources:
        raise ValueError(f"more than {max_sources} sources")
    names = [r.source for r in wanted]
    part = docs.select(F.col(id_col).alias("doc"), F.col(source_col).alias("source"), F.col(text_col).alias("text")).filter(F.col("source").isin(names))
    counted = materialize(token_counts(part, "doc", "text", vocabulary or default_vocabulary(), "source").filter("tokens > 0"), "tokens")
    sums = {r.source: (r.tokens, r.n) for r in counted.groupBy("source").agg(F.sum("tokens").alias("tokens"), F.count("*").alias("n")).collect()}
    live = [r for r in wanted if sums.get(r.source, (0, 0))[0] > 0 and r.target_share > 0 and r.max_repeats > 0]
    share = sum(r.target_share for r in live)
    most = min((sums[r.source][0] * r.max_repeats * share / r.target_share for r in live), default=0)
    total = most if total_tokens is None else total_tokens
    if block_tokens is None:
        least = min((r.target_share / share for r in live), default=0)
        block_tokens = max(16, min(1024, int(total * least / 1000)))
    slots = int(total // block_tokens)
    plan = materialize(schedule(spark, [(r.source, r.target_share) for r in live] or [("", 1.0)], slots if live else 0, points), "schedule")
    per_source = {r.source: r["count"] for r in plan.groupBy("source").count().collect()}

    buckets = max(1, -(-sum(n for _, n in sums.values()) // bucket_rows))
    order = F.xxhash64(F.lit(seed), "doc")
    rows = counted.withColumn("_h", order)
    placed = running_sum(rows, "source", F.floor((F.shiftrightunsigned("_h", 1).cast("double") / 2.0**63) * buckets), ["_h", "doc"], F.col("tokens"), "start")
    facts = spark.createDataFrame([(r.source, int(sums[r.source][0]), int(r.max_repeats), int(per_source.get(r.source, 0)) * block_tokens) for r in live], "source string, _size long, _cap int, _need long")
    copies = F.least(F.col("_cap").cast("long"), F.ceil((F.col("_need") - F.col("start")) / F.col("_size")))
    used = placed.join(F.broadcast(facts), "source").filter(F.col("start") < F.col("_need")).withColumn("copy", F.explode(F.sequence(F.lit(0).cast("long"), copies - 1)))
    used = used.withColumn("place", F.col("copy") * F.col("_size") + F.col("start")).withColumn("block", F.floor(F.col("place") / block_tokens))
    mixture = used.join(plan, ["source", "block"]).select("slot", "source", F.col("doc").alias(id_col), "copy", "tokens", "place")
    goal = spark.createDataFrame([(r.source, float(r.target_share), int(r.max_repeats)) for r in wanted], "source string, target_share double, max_repeats int")
    got = mixture.groupBy("source").agg(F.sum("tokens").alias("tokens"), F.count("*").alias("n_rows"), F.max(F.col("copy") + 1).alias("most_copies"))
    got = goal.join(got, "source", "left").fillna(0, ["tokens", "n_rows", "most_copies"])
    whole = got.agg(F.sum("tokens").alias("_all"))
    report = got.crossJoin(F.broadcast(whole)).select("source", "target_share", "max_repeats", "tokens", "n_rows", "most_copies", F.coalesce(F.try_divide(F.col("tokens"), F.col("_all")), F.lit(0.0)).alias("actual_share"))
    return mixture, report
