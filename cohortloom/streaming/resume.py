"""Idempotent batch processing as a stream: every record id is processed once, over any number of restarts."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.lookup import path_exists
from ..workspace import materialize


def pending(source: DataFrame, done: DataFrame, id_col: str) -> DataFrame:
    """Input rows whose id isn't in the output yet."""
    return source.join(done.select(id_col).distinct(), id_col, "left_anti")


def append_new(df: DataFrame, target: str, id_col: str) -> None:
    """Appends the rows whose id ``target`` doesn't have; the first write makes it."""
    spark = df.sparkSession
    new = pending(df, spark.read.parquet(target), id_col) if path_exists(spark, target) else df
    new.write.mode("append").parquet(target)


def run_resumable(spark: SparkSession, source: str, schema, target: str, checkpoint: str, transform: Callable[[DataFrame], DataFrame], id_col: str, files_per_trigger: int = 1, cap: int | None = None) -> int:
    """Processes all files that have come, one chunk of files at a time, and appends to ``target``; returns the number of chunks.

    The checkpoint holds which files are done. A chunk is cut down to one row an id and to the ids that the target
    doesn't have, so neither a restart nor a record that comes again loses or repeats one, and no state grows with the
    ids seen. Before the chunk beyond ``cap`` is worked on, an error ends the run; what is done stays done.
    """
    chunks = 0

    def write(batch: DataFrame, batch_id: int) -> None:
        nonlocal chunks
        if cap is not None and chunks >= cap:
            raise RuntimeError(f"more than {cap} chunks")
        rows = batch.dropDuplicates([id_col])
        if path_exists(spark, target):
            rows = pending(rows, spark.read.parquet(target), id_col)
        # the target is read above: the new rows stand on their own before they are added
        materialize(transform(rows).withColumn("_batch", F.lit(batch_id)), "chunk").write.mode("append").parquet(target)
        chunks += 1

    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_trigger).parquet(source)
    query = stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()
    if query.exception() is not None:
        raise query.exception()
    return chunks


def run_until_done(spark: SparkSession, source: str, schema, target: str, checkpoint: str, transform: Callable[[DataFrame], DataFrame], id_col: str, files_per_trigger: int = 1, max_chunks: int = 1000, on_progress: Callable[[dict], None] | None = None, poll: float = 0.2) -> list[dict]:
    """Runs to the end under a lock, watching the progress: one entry a chunk with its state and rows, the last ``completed``.

    A second run on the same checkpoint raises an error while the lock is there; a failed chunk ends the run with its
    error and takes the lock away, so the next start goes on behind the last finished chunk.
    """
    lock = f"{checkpoint}.lock"
    p, fs = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(lock), None
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.createNewFile(p):
        raise RuntimeError(f"{checkpoint} is in use")
    seen: list[dict] = []
    try:

        def write(batch: DataFrame, batch_id: int) -> None:
            if len(seen) >= max_chunks:
                raise RuntimeError(f"more than {max_chunks} chunks")
            rows = batch.dropDuplicates([id_col])
            if path_exists(spark, target):
                rows = pending(rows, spark.read.parquet(target), id_col)
            done = materialize(transform(rows).withColumn("_batch", F.lit(batch_id)), "chunk")
            done.write.mode("append").parquet(target)
            seen.append({"chunk": batch_id, "state": "running", "rows": done.count()})
            if on_progress:
                on_progress(seen[-1])

        stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_trigger).parquet(source)
        query = stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
        while not query.awaitTermination(poll):
            pass
        if query.exception() is not None:
            raise query.exception()
        seen.append({"chunk": None, "state": "completed", "rows": 0})
        return seen
    finally:
        fs.delete(p, False)


def windowed_counts(events: DataFrame, at: str, key: str, window: str = "1 hour", late: str = "2 hours") -> DataFrame:
    """Extension: event-time counts per window and key; works on streams and on tables."""
    df = events.withWatermark(at, late) if events.isStreaming else events
    return df.groupBy(F.window(at, window).alias("w"), key).agg(F.count("*").alias("n")).select(F.col("w.start").alias("window_start"), key, "n")
