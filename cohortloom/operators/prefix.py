"""Running sums and ranks over groups of any size, in two levels: within buckets, and over the buckets' sums."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def running_sum(df: DataFrame, group: str, bucket: Column, order: list[str], value: Column, name: str) -> DataFrame:
    """Adds ``name``, the sum of ``value`` over the rows of the same group before this one.

    Rows are ordered by bucket, then by ``order``, which must be unique within a bucket; a bucket must be small
    enough for one task. Null groups form a group of their own, and null values count as 0.
    """
    rows = df.withColumn("_bucket", bucket).withColumn("_value", F.coalesce(value, F.lit(0)))
    sums = rows.groupBy(F.col(group).alias("_group"), F.col("_bucket").alias("_b")).agg(F.sum("_value").alias("_sum"))
    over = Window.partitionBy("_group").orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sums.withColumn("_offset", F.coalesce(F.sum("_sum").over(over), F.lit(0))).drop("_sum")
    inner = Window.partitionBy(group, "_bucket").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    rows = rows.withColumn("_before", F.coalesce(F.sum("_value").over(inner), F.lit(0)))
    joined = rows.join(offsets, F.col(group).eqNullSafe(F.col("_group")) & (F.col("_bucket") == F.col("_b")))
    return joined.withColumn(name, F.col("_offset") + F.col("_before")).drop("_bucket", "_value", "_group", "_b", "_offset", "_before")
