"""Sources behind a function: keyed lookups with retry and a file cache, paged sources, two-step searches.

The function that fetches is injected, so the same plan runs against a service, a file or a test double.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..workspace import materialize


class Transient(Exception):
    """A failure that may pass: the call is tried again."""


def retrying(fetch: Callable, attempts: int = 3, base_delay: float = 2.0, sleep: Callable[[float], None] = time.sleep) -> Callable:
    """``fetch`` that tries again after a Transient failure, waiting base_delay, twice that, and so on; the last failure is raised."""

    def call(*args):
        for k in range(attempts):
            try:
                return fetch(*args)
            except Transient:
                if k + 1 == attempts:
                    raise
                sleep(base_delay * 2**k)

    return call


def path_exists(spark: SparkSession, path: str) -> bool:
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p)


def cached_lookup(spark: SparkSession, keys: DataFrame, key: str, fetch: Callable[[str], str | None], cache: str, attempts: int = 3, base_delay: float = 2.0) -> DataFrame:
    """(key, value, error, source) of every distinct non-null key: ``cache`` for those that the cache folder has, else ``fetch``.

    Missing keys are fetched once each, in parallel; answers, null ones too, are appended to the cache, failures aren't.
    """
    schema = f"{key} string, value string, error string"
    wanted = keys.select(F.col(key).cast("string").alias(key)).filter(F.col(key).isNotNull()).distinct()
    have = spark.read.schema(f"{key} string, value string").parquet(cache) if path_exists(spark, cache) else spark.createDataFrame([], f"{key} string, value string")
    have = have.dropDuplicates([key])

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        call = retrying(fetch, attempts, base_delay)
        for b in batches:
            rows = []
            for k in b[key]:
                try:
                    rows.append((k, call(k), None))
                except Exception as e:
                    rows.append((k, None, f"{type(e).__name__}: {e}"))
            yield pd.DataFrame(rows, columns=[key, "value", "error"])

    hits = materialize(wanted.join(have, key).select(key, "value", F.lit(None).cast("string").alias("error"), F.lit("cache").alias("source")), "cache-hits")
    fresh = materialize(wanted.join(have.select(key), key, "left_anti").mapInPandas(run, schema), "fetched")
    fresh.filter("error is null").select(key, "value").write.mode("append").parquet(cache)
    return hits.unionByName(fresh.withColumn("source", F.lit("fetch")))


def paged_until_short(spark: SparkSession, fetch: Callable[[int, int], list[tuple]], schema: T.StructType, page_size: int = 1000, max_pages: int = 50) -> DataFrame:
    """Rows of a paged source, up to and with its first page of fewer than ``page_size`` rows, ``max_pages`` at most; one task a page.

    Pages behind the first short one are asked too, since tasks run side by side, and left out.
    """
    out = T.StructType([T.StructField("page", T.LongType()), T.StructField("rows", T.ArrayType(schema))])
    names = schema.fieldNames()

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for page in b["id"]:
                yield pd.DataFrame({"page": [page], "rows": [[dict(zip(names, r)) for r in fetch(int(page), page_size)]]})

    pages = materialize(spark.range(0, max_pages, 1, max_pages).mapInPandas(run, out), "pages")
    last = pages.filter(F.size("rows") < page_size).agg(F.min("page")).first()[0]
    return pages.filter(F.col("page") <= (max_pages if last is None else last)).select(F.explode("rows").alias("r")).select("r.*")


def two_step_search(search: Callable[[int, int], list[tuple[str, object]]], key: str, first: int = 50, size: int = 1000, pages: int = 3) -> object | None:
    """The payload of the first node whose comma list holds ``key``: in a short first answer, else in up to ``pages`` long pages."""
    for start, n in [(0, first), *[(k * size, size) for k in range(pages)]]:
        nodes = search(start, n)
        for ids, payload in nodes:
            if key in [x.strip() for x in (ids or "").split(",")]:
                return payload
        if n == size and len(nodes) < size:
            break
    return None
