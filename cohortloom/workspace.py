"""Shared storage for intermediate tables.

Lineage is cut by writing a table to the folder named by ``spark.checkpoint.dir``, which all
executors share, so a lost executor never loses an intermediate result.
"""

from __future__ import annotations

import atexit
import re
import tempfile
import uuid
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession

_made: list[tuple[SparkSession, str]] = []


def shared_dir(spark: SparkSession) -> str:
    """The cluster's checkpoint folder; a temporary folder of this machine only where none is set and all tasks run in this process."""
    set_dir = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if set_dir:
        return set_dir.rstrip("/")
    if not re.fullmatch(r"local(\[[^\]]*\])?", spark.sparkContext.master):
        raise ValueError("spark.checkpoint.dir must name a shared folder on a cluster")
    own = "file://" + tempfile.mkdtemp(prefix="cohortloom-")
    spark.sparkContext.setCheckpointDir(own)
    return own


def _drop_all() -> None:
    for spark, path in _made:
        try:
            jvm = spark.sparkContext._jvm
            p = jvm.org.apache.hadoop.fs.Path(path)
            p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)
        except Exception:  # the JVM may be gone already
            pass
    _made.clear()


atexit.register(_drop_all)


def materialize(df: DataFrame, tag: str, options: dict[str, str] | None = None) -> DataFrame:
    """Writes ``df`` once to the shared folder and reads it back; the folder is removed when the program ends."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/cohortloom/{tag}-{uuid.uuid4().hex}"
    _made.append((spark, path))
    df.write.options(**(options or {})).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def discard(df: DataFrame) -> None:
    """Removes a table of ``materialize`` that nothing reads any more."""
    spark = df.sparkSession
    jvm = spark.sparkContext._jvm
    for folder in {f.rpartition("/")[0] for f in df.inputFiles()}:
        p = jvm.org.apache.hadoop.fs.Path(folder)
        p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


def spread(df: DataFrame) -> DataFrame:
    """``df`` in enough partitions for all cores, for work that costs much per row; large inputs have them already."""
    wanted = 3 * df.sparkSession.sparkContext.defaultParallelism
    return df if df.rdd.getNumPartitions() >= wanted // 3 * 2 else df.repartition(wanted)


def whole_groups(batches: Iterator[pd.DataFrame], column: str) -> Iterator[pd.DataFrame]:
    """The groups of equal ``column`` out of batches in which the rows of a group follow each other, one frame each."""
    held: list[pd.DataFrame] = []
    for b in batches:
        values = b[column].to_numpy()
        cuts = [0, *((values[1:] != values[:-1]).nonzero()[0] + 1).tolist(), len(b)]
        for s, t in zip(cuts, cuts[1:]):
            if s == t:
                continue
            if held and held[-1][column].iloc[-1] != values[s]:
                yield pd.concat(held, ignore_index=True)
                held = []
            held.append(b.iloc[s:t])
    if held:
        yield pd.concat(held, ignore_index=True)
