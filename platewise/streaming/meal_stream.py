"""Daily nutrient intake from a stream of landed meal-log files.

The warehouse only runs in batch (its README notes production would need
event streaming). This is the Structured Streaming form of the same chain:

  landed raw meal-log files (readStream, declared schema)
  -> B4 staging -> C2 unpivot -> C3 stream-static join with a food table
  -> foreachBatch: each micro-batch's exact sums per user and day, written to
     the batch's own partition of the sink.

Files may come in any order and days late: a micro-batch adds what it holds to
whichever days it holds, and the answer is the sum over all batches. So there
is no state to keep, no watermark, and no row is dropped. A micro-batch that is
replayed after a failure overwrites its own partition with the same rows. Rows
of days before the newest day seen in earlier batches are counted as late.
``compact`` folds the batches of a finished run into one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .. import schemas
from ..operators import staging as S
from ..operators import transforms as T
from ..operators import writes as W

BATCH = "batch_id"


def _write_sums(sink: str):
    def write_batch(batch: DataFrame, batch_id: int) -> None:
        sums = T.grouped_grams(batch, T.DAY_KEYS).withColumn(BATCH, F.lit(batch_id).cast("long"))
        W._swap_partitions(sums, sink, [BATCH])
    return write_batch


def run_daily_intake_stream(spark: SparkSession, landing: str, foods: DataFrame, sink: str, checkpoint: str,
                            tz: str = "UTC", max_files_per_trigger: int | None = None, available_now: bool = True):
    """Start (and, with ``available_now``, finish) the stream; returns the query.

    ``foods`` is read in every micro-batch: give a table, not a chain from raw."""
    reader = spark.readStream.schema(schemas.RAW_MEAL_LOGS)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    items = T.meal_items(S.stg_meal_logs(reader.parquet(landing), tz))
    writer = (T.scaled_nutrients(items, foods).writeStream.outputMode("append")
              .option("checkpointLocation", checkpoint)
              .foreachBatch(_write_sums(sink)))
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="1 minute")
    q = writer.start()
    if available_now:
        q.awaitTermination()
    return q


def read_daily(spark: SparkSession, sink: str) -> DataFrame:
    """Daily grams per user and nutrient over all micro-batches so far (C4 without its window)."""
    return T.daily_totals(spark.read.parquet(sink))


def late_rows(spark: SparkSession, sink: str) -> DataFrame:
    """(batch_id, late): user-days of a batch that lie before the newest day of the batches before it."""
    days = spark.read.parquet(sink).select(BATCH, "logged_date")
    newest = days.groupBy(BATCH).agg(F.max("logged_date").alias("newest"))
    earlier = Window.orderBy(BATCH).rowsBetween(Window.unboundedPreceding, -1)  # one row per batch
    before = newest.select(BATCH, F.max("newest").over(earlier).alias("before"))
    return days.join(before, BATCH).groupBy(BATCH).agg(F.count_if(F.col("logged_date") < F.col("before")).alias("late"))


def compact(spark: SparkSession, sink: str) -> None:
    """Fold all batches of a stopped stream into the newest one's partition."""
    rows = spark.read.parquet(sink)
    last = rows.agg(F.max(BATCH)).first()[0]
    with W.staged(T.grouped_grams(rows, T.DAY_KEYS).withColumn(BATCH, F.lit(last).cast("long")), sink, [BATCH]) as new:
        W.replace_table(new, sink, [BATCH])
