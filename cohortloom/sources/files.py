"""File sources and sinks with declared columns."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def all_strings(columns: list[str]) -> T.StructType:
    return T.StructType([T.StructField(c, T.StringType()) for c in columns])


def require(df: DataFrame, columns: list[str]) -> DataFrame:
    """``df`` if it has the columns, else an error that names what is missing."""
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise ValueError(f"missing columns: {', '.join(missing)}")
    return df


def read_table(spark: SparkSession, path: str, required: list[str], separator: str = "\t", null_text: str = "NA") -> DataFrame:
    """Delimited text with a header, all columns as strings, a null marker, required columns checked."""
    df = spark.read.option("sep", separator).option("header", True).option("nullValue", null_text).option("multiLine", False).csv(path)
    return require(df, required).select([F.col(f"`{c}`").cast("string").alias(c) for c in df.columns])


def read_jsonl(spark: SparkSession, path: str, schema: T.StructType, strict: bool = False) -> DataFrame:
    """JSON lines; lenient reading leaves out blank and unreadable lines, strict reading fails on them."""
    if strict:
        return spark.read.schema(schema).option("mode", "FAILFAST").json(path)
    lines = spark.read.text(path).filter(F.trim("value") != "")
    readable = lines.filter(F.try_parse_json("value").isNotNull())
    return readable.select(F.from_json("value", schema).alias("r")).select("r.*")


def read_json_documents(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Whole JSON documents, one or an array per file, with the file's name for ordering."""
    return spark.read.schema(schema).option("multiLine", True).json(path).withColumn("file_name", F.col("_metadata.file_name"))


def read_shards(spark: SparkSession, glob: str, key: str, path_order: bool = False, wanted: DataFrame | None = None) -> DataFrame:
    """JSON-line shards by glob, the first readable row of a key kept, in order of file name (or whole path) and place in the file.

    The key is read off the raw line by its pattern, and with ``wanted`` (a table with ``key``) other lines go before any
    JSON is parsed; lines without the key or that aren't JSON are left out.
    """
    name = F.col("_metadata.file_path" if path_order else "_metadata.file_name")
    lines = spark.read.text(glob).select("value", name.alias("file_name"), F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("line"))
    keyed = lines.withColumn("key", F.regexp_extract("value", f'"{key}"\\s*:\\s*"([^"]+)"', 1)).filter("key <> ''")
    if wanted is not None:
        keyed = keyed.join(wanted.select("key").distinct(), "key", "left_semi")
    return keyed.filter(F.try_parse_json("value").isNotNull()).groupBy("key").agg(F.min_by("value", F.struct("file_name", "block", "line")).alias("value"))


def write_split(df: DataFrame, root: str, outputs: dict[str, str]) -> None:
    """Filtered side outputs of one table, each a predicate, written as JSON lines; the table is read once."""
    df = df.persist()
    try:
        for name, predicate in outputs.items():
            df.filter(predicate).write.mode("overwrite").json(f"{root}/{name}")
    finally:
        df.unpersist()


def write_rejects(df: DataFrame, path: str, columns: list[str]) -> None:
    df.select(*columns).write.mode("overwrite").option("sep", "\t").option("header", True).csv(path)


def write_template(df: DataFrame, path: str, order: list[str]) -> None:
    """Sorted CSV with empty text for null."""
    df.orderBy(*order).coalesce(1).write.mode("overwrite").option("header", True).option("nullValue", "").csv(path)


def provenance(spark: SparkSession, path: str, label: str) -> DataFrame:
    """Path, size and md5 of files, one row a file."""
    return spark.read.format("binaryFile").load(path).select("path", F.col("length").alias("n_bytes"), F.md5("content").alias("md5"), F.lit(label).alias("label"))


def bundle_manifest(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """One-row summary of a batch input: records, distinct ids, bytes, and a content hash that doesn't depend on order."""
    line = F.octet_length(F.coalesce(text_col, F.lit("")))
    return df.agg(F.count("*").alias("n_records"), F.count_distinct(id_col).alias("n_ids"), F.coalesce(F.sum(line), F.lit(0)).alias("n_bytes"), F.max(line).alias("max_bytes"))


def paged(spark: SparkSession, fetch, pages: int, schema: str, page_size: int = 1000) -> DataFrame:
    """Rows of a paged source, one task a page: ``fetch(page, page_size)`` returns rows as tuples and is retried by the engine."""

    def run(batches):
        import pandas as pd

        names = [f.split()[0] for f in schema.split(",")]
        for b in batches:
            for page in b["id"]:
                yield pd.DataFrame(list(fetch(int(page), page_size)), columns=names)

    return spark.range(0, pages, 1, max(1, pages)).mapInPandas(run, schema)
