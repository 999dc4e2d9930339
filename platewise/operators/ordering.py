"""A global order made explicit, as a column that survives any later exchange.

Rows are dealt by ranges of the sort keys and sorted within each range, so no task sees more than its range; each is
numbered there, and the ranges' row counts (one number per range) shift the numbers to places in the whole."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import scratch_dir


def with_position(df: DataFrame, *order: Column, position: str = "position") -> DataFrame:
    """``df`` with the place (from 1) of each row in ``order``. Rows that tie in every key are numbered in any order."""
    spark, path = df.sparkSession, scratch_dir(df.sparkSession, "ordered")
    df.orderBy(*order).withColumn("_at", F.monotonically_increasing_id()).write.parquet(path)
    rows = spark.read.parquet(path).withColumn("_range", F.shiftright("_at", 33))
    counts = rows.groupBy("_range").agg(F.count(F.lit(1)).alias("_n"))
    earlier = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)  # one row per range
    starts = counts.select(F.col("_range").alias("_of"), F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_start"))
    return rows.join(F.broadcast(starts), F.col("_range") == F.col("_of")).select(
        *df.columns, (F.col("_start") + F.col("_at").bitwiseAND(F.lit((1 << 33) - 1)) + 1).alias(position))
