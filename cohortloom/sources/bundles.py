"""Bundles of batch runs: input, prompt, schema, generation settings, manifest and status in one folder, a registry and an event log."""

from __future__ import annotations

import json
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .lookup import path_exists


def _fs(spark: SparkSession, path: str):
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def replace_text(spark: SparkSession, path: str, text: str) -> None:
    """Writes a small file so that a reader sees the old or the new content: to a temporary name, then renamed."""
    new, fs = _fs(spark, path + ".tmp")
    old, _ = _fs(spark, path)
    out = fs.create(new, True)
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()
    if not fs.rename(new, old):
        # file systems that don't rename over a file
        fs.delete(old, False)
        if not fs.rename(new, old):
            raise OSError(f"can't replace {path}")


def read_text(spark: SparkSession, path: str) -> str:
    return spark.read.option("wholetext", True).text(path).first()[0]


def generation_json(settings: dict) -> str:
    """Settings as JSON; whole numbers that are fractions by nature keep their decimal point."""
    fractions = {"temperature", "top_p", "repetition_penalty"}
    return json.dumps({k: float(v) if k in fractions and v is not None else v for k, v in settings.items()}, sort_keys=True)


def write_bundle(spark: SparkSession, df: DataFrame, id_col: str, root: str, run_id: str, stage: str, prompt: str, schema: dict, settings: dict) -> dict:
    """Writes the bundle's six parts, a registry row and a ``created`` event; returns the manifest.

    Null or repeated ids raise an error before anything is written; an existing bundle isn't written over.
    """
    folder = f"{root}/{run_id}"
    if path_exists(spark, folder):
        raise FileExistsError(folder)
    n, distinct = df.agg(F.count("*"), F.count_distinct(id_col)).first()
    if n != distinct:
        raise ValueError(f"{n - distinct} null or repeated ids")
    df.write.json(f"{folder}/input")
    manifest = {"run_id": run_id, "stage": stage, "n_records": n, "created_at": datetime.now(timezone.utc).strftime("%Y-%m-%dT%H:%M:%SZ")}
    for name, text in {
        "prompt.txt": prompt, "schema.json": json.dumps(schema, sort_keys=True), "generation.json": generation_json(settings),
        "status.json": json.dumps({"state": "created"}), "manifest.json": json.dumps(manifest, sort_keys=True),
    }.items():
        replace_text(spark, f"{folder}/{name}", text)
    append_row(spark, f"{root}/_registry", {"run_id": run_id, "stage": stage, "state": "created", "n_records": n})
    append_row(spark, f"{root}/_events", {"run_id": run_id, "event": "created", "at": manifest["created_at"]})
    return manifest


def recover(spark: SparkSession, root: str, run_id: str) -> dict:
    """The handle of a run from its manifest alone; an error names a run that has none."""
    path = f"{root}/{run_id}/manifest.json"
    if not path_exists(spark, path):
        raise FileNotFoundError(f"no bundle of run {run_id}")
    m = json.loads(read_text(spark, path))
    return {"run_id": m["run_id"], "stage": m["stage"], "n_records": m["n_records"], "job_id": None, "folder": f"{root}/{run_id}"}


def append_row(spark: SparkSession, path: str, row: dict) -> None:
    """One row to an append-only table; columns may come later, older rows have null there."""
    spark.createDataFrame([tuple(row.values())], ", ".join(f"{k} {'long' if isinstance(v, int) else 'string'}" for k, v in row.items())).write.mode("append").parquet(path)


def read_log(spark: SparkSession, path: str, columns: dict[str, str]) -> DataFrame:
    """An append-only table under its present columns (name to type): what an older file lacks is null."""
    return spark.read.schema(", ".join(f"{k} {v}" for k, v in columns.items())).parquet(path)


def listing(runs: DataFrame, at: str, states: list[str] | None = None, limit: int | None = None) -> DataFrame:
    """Runs newest first, those without a time last; only of some states, and only the first ones, if wished."""
    out = runs.filter(F.col("state").isin(states)) if states else runs
    out = out.orderBy(F.col(at).desc_nulls_last(), "run_id")
    return out.limit(limit) if limit is not None else out


def provenance(spark: SparkSession, path: str, label: str, url: str | None = None) -> DataFrame:
    """One row a file: path, bytes, md5, time of the record in UTC, url, label."""
    now = datetime.now(timezone.utc).strftime("%Y-%m-%dT%H:%M:%SZ")
    return spark.read.format("binaryFile").load(path).select("path", F.col("length").alias("n_bytes"), F.md5("content").alias("md5"), F.lit(now).alias("recorded_at"), F.lit(url).cast("string").alias("url"), F.lit(label).alias("label"))
