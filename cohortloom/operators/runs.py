"""Key-value cache over an append-only log, run registry and monotone run states."""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.lookup import path_exists
from ..workspace import materialize

# --- fixed values: scheduler states ----------------------------------------------------------------------
QUEUED = ("pending", "configuring", "resv_del_hold", "requeue_hold", "suspended")
RUNNING = ("running", "completing", "stage_out")
FAILED = ("failed", "timeout", "out_of_memory", "preempted", "node_fail", "boot_fail", "deadline", "revoked")
TERMINAL = ("completed", "failed", "cancelled", "collected")
# seconds: start, per chunk, per record, tokens per second
LARGE_JOB, SMALL_JOB = (120, 30, 2.0, 180), (90, 20, 1.5, 350)
JOB_MARGIN, JOB_LEAST, TOO_LOW, FAR_TOO_HIGH, HOURS_TOO_HIGH = 1.2, 300, 0.8, 3, 7200
# ---------------------------------------------------------------------------------------------------------


def cache_path(root: str, namespace: str) -> str:
    if not re.fullmatch(r"[A-Za-z0-9_-]+", namespace):
        raise ValueError(f"bad cache namespace: {namespace}")
    return f"{root.rstrip('/')}/{namespace}"


def cache_put(df: DataFrame, root: str, namespace: str) -> None:
    """Appends (key, value, put_at) rows to the log."""
    df.select("key", "value", "put_at").write.mode("append").parquet(cache_path(root, namespace))


def latest(log: DataFrame, key: str = "key", at: str = "put_at", tie: str | None = None) -> DataFrame:
    """The last written row of each key, as an aggregation."""
    order = F.struct(at, *([tie] if tie else []))
    rest = [c for c in log.columns if c != key]
    return log.groupBy(key).agg(F.max_by(F.struct(*rest), order).alias("_m")).select(key, *[F.col("_m")[c].alias(c) for c in rest])


def cache_get(spark: SparkSession, root: str, namespace: str, keys: DataFrame) -> DataFrame:
    """The latest value of each wanted key that the log has."""
    log = spark.read.parquet(cache_path(root, namespace)).join(keys.select("key").distinct(), "key", "left_semi")
    return latest(log)


def cache_stats(log: DataFrame) -> DataFrame:
    return log.agg(F.count("*").alias("n_entries"), F.count_distinct("key").alias("n_keys"))


def read_through(requests: DataFrame, log: DataFrame, compute: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """(key, value, hit): cached values where the log has the key, else computed ones; each missing key is computed once."""
    known = latest(log).select("key", "value")
    wanted = requests.select("key", "payload").dropDuplicates(["key"])
    hits = wanted.join(known, "key").select("key", "value", F.lit(True).alias("hit"))
    misses = wanted.join(known.select("key"), "key", "left_anti")
    return hits.unionByName(compute(misses).select("key", "value", F.lit(False).alias("hit")))


def stored_read_through(spark: SparkSession, requests: DataFrame, store: str, compute: Callable[[DataFrame], DataFrame], valid: Column) -> DataFrame:
    """(key, value, hit) over a store: missing keys are computed once, those that pass ``valid`` are appended to the store and returned."""
    known = spark.read.schema("key string, value string").parquet(store) if path_exists(spark, store) else spark.createDataFrame([], "key string, value string")
    known = known.dropDuplicates(["key"])
    wanted = requests.select("key", "payload").filter(F.col("key").isNotNull()).dropDuplicates(["key"])
    hits = materialize(wanted.join(known, "key").select("key", "value", F.lit(True).alias("hit")), "hits")
    fresh = materialize(compute(wanted.join(known.select("key"), "key", "left_anti")).filter(valid).select("key", "value", F.lit(False).alias("hit")), "computed")
    fresh.select("key", "value").write.mode("append").parquet(store)
    return hits.unionByName(fresh)


def run_upsert(log: DataFrame, key: str, at: str) -> DataFrame:
    """Current rows of a registry of partial updates: per column the last value that isn't null."""
    cols = [c for c in log.columns if c not in (key, at)]
    return log.groupBy(key).agg(*[F.max_by(F.when(F.col(c).isNotNull(), F.col(c)), F.when(F.col(c).isNotNull(), F.col(at))).alias(c) for c in cols], F.max(at).alias(at))


def scheduler_state(raw: Column) -> Column:
    """Raw scheduler state to one of six; a suffix from + on is cut, blank gives null, unknown gives submitted."""
    x = F.regexp_replace(F.lower(F.trim(F.coalesce(raw, F.lit("")))), r"\+.*$", "")
    return (
        F.when(x == "", F.lit(None).cast("string")).when(x.isin(*QUEUED), "queued").when(x.isin(*RUNNING), "running").when(x == "completed", "completed")
        .when(x.startswith("cancelled"), "cancelled").when(x.isin(*FAILED), "failed").otherwise("submitted")
    )


def stable_state(events: DataFrame, run: str, order: list[str], state: str) -> DataFrame:
    """(run, state, n_events): the state after all events in order; a terminal state never goes back to one that isn't, and collected absorbs completed.

    The fold is written as an aggregation: the last terminal event decides if there is one, and where it says
    completed an earlier collected since the last other terminal event stands.
    """
    o = F.struct(*order)
    terminal = F.col(state).isin(*TERMINAL)
    other = F.col(state).isin("failed", "cancelled")
    first = events.filter(F.col(state).isNotNull() & (F.col(state) != "")).groupBy(run).agg(
        F.count("*").alias("n_events"),
        F.max_by(F.when(terminal, F.col(state)), F.when(terminal, o)).alias("last_terminal"),
        F.max_by(state, o).alias("last_any"),
        F.max(F.when(other, o)).alias("last_other"),
        F.max(F.when(F.col(state) == "collected", o)).alias("last_collected"),
    )
    collected = F.col("last_collected").isNotNull() & (F.col("last_other").isNull() | (F.col("last_collected") > F.col("last_other")))
    out = F.when(F.col("last_terminal").isNull(), F.col("last_any")).when((F.col("last_terminal") == "completed") & collected, "collected").otherwise(F.col("last_terminal"))
    return first.select(run, out.alias("state"), "n_events")


def progress(total: Column, done: Column, failed: Column) -> dict[str, Column]:
    """Pending count, at least 0, and the finished share; null where the total is unknown or 0."""
    d, f = F.coalesce(done, F.lit(0)), F.coalesce(failed, F.lit(0))
    return {"n_pending": F.when(total.isNotNull(), F.greatest(total - d - f, F.lit(0))), "share_done": F.try_divide(d + f, total)}


def job_seconds(chunks: Column, records: Column, tokens: Column, large: bool = False) -> Column:
    """Heuristic run time: start, chunks, records and tokens, plus a minute, a fifth on top, five minutes at least."""
    start, per_chunk, per_record, rate = LARGE_JOB if large else SMALL_JOB
    seconds = start + F.coalesce(chunks, F.lit(0)) * per_chunk + F.coalesce(records, F.lit(0)) * per_record + F.coalesce(tokens, F.lit(0)) / rate
    return F.greatest(F.lit(JOB_LEAST).cast("long"), F.ceil((seconds + 60) * JOB_MARGIN))


def time_status(requested: Column, estimated: Column) -> Column:
    return F.when(requested < estimated * TOO_LOW, "too_low").when(requested > F.greatest(estimated * FAR_TOO_HIGH, estimated + HOURS_TOO_HIGH), "suspiciously_high").otherwise("ok")
