"""The window idioms the warehouse documents (running total, lead, first
value) and de-duplication, as plain Spark expressions.

Windows partition by the caller's keys; apply them to already aggregated rows
(e.g. one row per user and day) so a hot key stays a bounded partition.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _w(partition: list[str], order: list[str | Column]):
    return Window.partitionBy(*partition).orderBy(*order)


def running_total(value: str, partition: list[str], order: list[str | Column]) -> Column:
    """Cumulative sum from the first row of the partition to the current one."""
    return F.sum(value).over(_w(partition, order).rowsBetween(Window.unboundedPreceding, Window.currentRow))


def next_value(value: str, partition: list[str], order: list[str | Column], offset: int = 1) -> Column:
    """The value ``offset`` rows ahead (NULL past the end)."""
    return F.lead(value, offset).over(_w(partition, order))


def previous_value(value: str, partition: list[str], order: list[str | Column], offset: int = 1) -> Column:
    """The value ``offset`` rows back (NULL before the start), as in MoM deltas."""
    return F.lag(value, offset).over(_w(partition, order))


def first_value(value: str, partition: list[str], order: list[str | Column]) -> Column:
    """The first value of the ordered partition, on every row."""
    return F.first(value).over(_w(partition, order).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))


def dedup_latest(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """One row per key: the row with the greatest ``order`` tuple.

    An aggregate (``max_by`` over a struct), so it is combined map-side and a
    key with a huge number of rows never becomes one sorted window partition.
    """
    rest = [c for c in df.columns if c not in keys]
    picked = df.groupBy(*keys).agg(F.max_by(F.struct(*rest), F.struct(*order)).alias("_row"))
    return picked.select(*keys, *[F.col("_row")[c].alias(c) for c in rest])
