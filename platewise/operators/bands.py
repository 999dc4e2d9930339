"""Join of values to half-open bands ``low <= value < high`` by interval binning.

A band of width w lies in at most two neighbouring bins of the least power of two that is not under w; it is listed in
those bins (a third one where rounding asks for it). A value lies in one bin of each such size, so it meets its bands
by an equi-join on (size, bin), after which both ends are checked. Gaps, overlaps, empty bands and any mixture of
widths are allowed; a NULL end is open. Neither side is compared row by row with the other: the values are repeated
once per distinct size among the bands (a scalar subquery, at most 2,100 sizes), and a bin that holds a third of the
values is split by AQE like any skewed join key.

What a band only counts, or takes the extremes of, is not listed pair by pair (``band_extremes``): wide bands over many
values would be as many rows as the two sides multiplied. There the sorted values are made into the gaps between them,
each with the number of values before it, and every end of a band is joined to the one gap that it lies in.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import scratch_dir
from ..sources import seeds

#: The largest finite double, and the exponent whose bins -2 to 1 hold all of them: the size of open bands.
LARGEST, OPEN = 1.7976931348623157e308, 1023


def _bin(x: Column, size: Column) -> Column:
    """The bin of a finite double, as a double: any number of bins, and large doubles are whole already."""
    at = x / F.pow(F.lit(2.0), size)
    return F.when(F.abs(at) < float(1 << 53), F.floor(F.when(F.abs(at) < float(1 << 53), at)).cast("double")).otherwise(at)


def _finite(x: Column) -> Column:
    return F.least(F.greatest(x.cast("double"), F.lit(-LARGEST)), F.lit(LARGEST))


def _holds(low: str, high: str) -> Column:
    """Whether a band is neither empty nor has a NaN end."""
    return F.coalesce(F.col(low) < F.col(high), F.lit(True)) & ~F.coalesce(F.isnan(F.col(low).cast("double")) | F.isnan(
        F.col(high).cast("double")), F.lit(False))


def binned_bands(bands: DataFrame, low: str, high: str) -> DataFrame:
    """``bands`` with ``_size`` (exponent) and ``_bin``, one row per bin; empty bands and NaN ends are left out."""
    lo = _finite(F.coalesce(F.col(low).cast("double"), F.lit(-LARGEST)))
    hi = _finite(F.coalesce(F.col(high).cast("double"), F.lit(LARGEST)))
    closed = (hi - lo <= LARGEST) & F.col(low).isNotNull() & F.col(high).isNotNull()
    # an empty double interval of unequal exact ends still has a bin
    size = F.when(closed, F.greatest(F.ceil(F.log2(F.greatest(hi - lo, F.lit(1e-300)))).cast("int"), F.lit(-1000))).otherwise(F.lit(OPEN))
    size = F.when(closed & (F.pow(F.lit(2.0), size) < hi - lo), size + 1).otherwise(size)
    b = bands.where(_holds(low, high)).select("*", lo.alias("_lo"), hi.alias("_hi"), size.alias("_size")).select(
        "*", _bin(F.col("_lo"), F.col("_size")).alias("_first"), _bin(F.col("_hi"), F.col("_size")).alias("_last"))
    listed = F.filter(F.array_distinct(F.array(*[F.col("_first") + k for k in range(4)], F.col("_last"))), lambda x: x <= F.col("_last"))
    return b.select(*bands.columns, "_size", F.explode(listed).alias("_bin"))


def band_join(values: DataFrame, value: str, bands: DataFrame, low: str, high: str) -> DataFrame:
    """Inner join: every row of ``values`` beside each band that holds its ``value``. NULL and NaN lie in no band.

    Column names of the two sides must differ. Bands under the bounded size of a lookup are broadcast."""
    listed = binned_bands(bands, low, high)
    sizes = listed.select(F.collect_set("_size").alias("s")).scalar()
    v = F.col(value)
    spread = values.where(v.isNotNull() & ~F.isnan(v.cast("double"))).select("*", F.explode(sizes).alias("_vsize"))
    spread = spread.withColumn("_vbin", _bin(_finite(v), F.col("_vsize")))
    met = spread.join(seeds.lookup(listed), (F.col("_vsize") == F.col("_size")) & (F.col("_vbin") == F.col("_bin")), "inner")
    inside = (F.col(low).isNull() | (v >= F.col(low))) & (F.col(high).isNull() | (v < F.col(high)))
    return met.where(inside).drop("_vsize", "_vbin", "_size", "_bin")


def value_gaps(values: DataFrame, value: str) -> DataFrame:
    """One row per distinct value ``_from`` (no NULL or NaN): its rows ``_n``, those of smaller values ``_before``, and the
    values next to it, ``_prev`` and ``_to``.

    The values are dealt by ranges and sorted there; one row per range carries the counts and values over the borders."""
    spark, v = values.sparkSession, F.col(value)
    path, out = (scratch_dir(spark, n) for n in ("values", "gaps"))
    counted = values.where(v.isNotNull() & ~F.isnan(v.cast("double"))).groupBy(v.alias("_from")).agg(F.count(F.lit(1)).alias("_n"))
    counted.orderBy("_from").withColumn("_at", F.monotonically_increasing_id()).write.parquet(path)
    rows = spark.read.parquet(path).withColumn("_range", F.shiftright("_at", 33))
    ranges = rows.groupBy("_range").agg(F.sum("_n").alias("_n"), F.min("_from").alias("_least"), F.max("_from").alias("_most"))
    order, own = Window.orderBy("_range"), Window.partitionBy("_range").orderBy("_at")  # the first over one row per range
    earlier = lambda over: F.coalesce(F.sum("_n").over(over.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    edges = ranges.select(F.col("_range").alias("_of"), earlier(order).alias("_start"),
                          F.lag("_most").over(order).alias("_under"), F.lead("_least").over(order).alias("_over"))
    rows.join(F.broadcast(edges), F.col("_range") == F.col("_of")).select(
        "_from", F.coalesce(F.lead("_from").over(own), "_over").alias("_to"), F.coalesce(F.lag("_from").over(own), "_under").alias("_prev"),
        "_n", (F.col("_start") + earlier(own)).alias("_before")).write.parquet(out)
    return spark.read.parquet(out)


def band_extremes(values: DataFrame, value: str, bands: DataFrame, key: str, low: str, high: str) -> DataFrame:
    """``key``, ``n``, ``least`` and ``most`` of the values that its bands hold; a key whose bands hold none has no row.

    The same as the ``band_join`` grouped by ``key``, from two rows per band."""
    gaps = value_gaps(values, value)
    whole = gaps.select(F.struct(
        F.min("_from").alias("least"), F.max("_from").alias("most"), F.sum("_n").alias("n"),
        F.max_by("_before", "_from").alias("before_most"), F.max_by("_prev", "_from").alias("under_most"))).scalar()
    ends = bands.where(_holds(low, high)).select(
        F.col(key).alias("_key"), F.col(low).alias("_low"), F.col(high).alias("_high"),
        F.inline(F.array(F.struct(F.lit(False).alias("_closes"), F.col(low).alias("_end")),
                         F.struct(F.lit(True).alias("_closes"), F.col(high).alias("_end")))))
    e, closes = F.col("_end"), F.col("_closes")
    within = F.coalesce((e > whole["least"]) & (e < whole["most"]), F.lit(False))
    low_end, top_end = e.isNull() & ~closes | (e <= whole["least"]), e == whole["most"]
    outside = ends.where(~within).select(
        "*", F.when(low_end, 0).when(top_end, whole["before_most"]).otherwise(whole["n"]).alias("_before"),
        F.when(low_end, whole["least"]).when(top_end, e).alias("_next"),
        F.when(low_end, None).when(top_end, whole["under_most"]).otherwise(whole["most"]).alias("_last"))
    past = e > F.col("_from")
    inside = band_join(ends.where(within), "_end", gaps.where(F.col("_to").isNotNull()), "_from", "_to").select(
        *ends.columns, (F.col("_before") + F.when(past, F.col("_n")).otherwise(0)).alias("_before"),
        F.when(past, F.col("_to")).otherwise(F.col("_from")).alias("_next"), F.when(past, F.col("_from")).otherwise(F.col("_prev")).alias("_last"))
    # a band without values has its next value behind its high end, and its last one before its low end
    least = F.when(~closes & (F.col("_high").isNull() | (F.col("_next") < F.col("_high"))), F.col("_next"))
    most = F.when(closes & (F.col("_low").isNull() | (F.col("_last") >= F.col("_low"))), F.col("_last"))
    return outside.unionByName(inside).groupBy(F.col("_key").alias(key)).agg(
        F.sum(F.when(closes, F.col("_before")).otherwise(-F.col("_before"))).alias("n"), F.min(least).alias("least"),
        F.max(most).alias("most")).where(F.col("n") > 0)
