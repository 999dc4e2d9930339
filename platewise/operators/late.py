"""Late and corrected rows found by comparing day sums.

Raw logs are kept by load and day. When a load has landed, a row per day with the number of its rows and sums of their
hashes is written beside it; the sums of all loads add up to those of the raw logs, day by day, without reading a log
again. The sums that a fact was last built from are kept beside the fact. Days whose sums differ have got late rows,
corrections or deletions: they, and no others, are read and rebuilt. The kept sums are replaced last, so a build that
ends early is simply found to differ once more.

Sums are map-side combined and do not depend on the order of rows: a hot day costs one partial row per task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schemas
from ..functions import to_utc
from ..session import remove_path
from . import versions as V

SUMS = "day date, rows long, low long, high long, mixed long"


def day_sums(rows: DataFrame, day: str = "day") -> DataFrame:
    """Per day: the number of rows and three order-free sums of their hashes (all other columns count)."""
    h = F.xxhash64(*[c for c in rows.columns if c != day])
    return rows.select(F.col(day).alias("day"), h.alias("_h")).groupBy("day").agg(
        F.count(F.lit(1)).alias("rows"), F.sum(F.col("_h").bitwiseAND(F.lit((1 << 24) - 1))).alias("low"),
        F.sum(F.shiftrightunsigned("_h", 40)).alias("high"), F.bit_xor("_h").alias("mixed"))


def land_load(logs: DataFrame, root: str, load: str, tz: str = "UTC") -> None:
    """Write one load of raw meal logs by (UTC) day; a load that comes again replaces its earlier rows.

    A load counts from the moment its sums are there; they are removed first and written last."""
    spark, root = logs.sparkSession, root.rstrip("/")
    remove_path(spark, f"{root}/sums/load={load}")
    day = F.to_date(to_utc("logged_at", dict(logs.dtypes)["logged_at"], tz))
    path = f"{root}/logs/load={load}"
    logs.select(*[f.name for f in schemas.RAW_MEAL_LOGS.fields]).withColumn("day", day).hint("rebalance", "day").write.mode(
        "overwrite").option("partitionOverwriteMode", "static").partitionBy("day").parquet(path)
    day_sums(spark.read.schema(_logs_schema()).parquet(path)).write.parquet(f"{root}/sums/load={load}")


def _logs_schema() -> str:
    return ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in schemas.RAW_MEAL_LOGS.fields) + ", day date"


def _sums(spark: SparkSession, root: str) -> DataFrame:
    path = f"{root.rstrip('/')}/sums"
    return spark.read.schema(f"{SUMS}, load string").parquet(path)


def read_logs(spark: SparkSession, root: str, days: list[str] | None = None) -> DataFrame:
    """The rows of all landed loads, of the given (ISO) days or all; other days' folders are not read."""
    landed = [r[0] for r in _sums(spark, root).select("load").distinct().collect()]  # one row per load
    logs = spark.read.schema(f"{_logs_schema()}, load string").parquet(f"{root.rstrip('/')}/logs").where(F.col("load").isin(landed))
    if days is not None:
        logs = logs.where(F.col("day").isin([F.lit(d).cast("date") for d in days]))
    return logs.drop("day", "load")


def raw_sums(spark: SparkSession, root: str) -> DataFrame:
    """Day sums of the raw logs, from those of the loads."""
    return _sums(spark, root).groupBy("day").agg(*[F.sum(c).alias(c) for c in ("rows", "low", "high")], F.bit_xor("mixed").alias("mixed"))


def changed_days(sums: DataFrame, kept: DataFrame | None) -> list[str]:
    """ISO days (a calendar's number of them at most) whose sums differ, or are on one side only."""
    if kept is None:
        return sorted(str(r[0]) for r in sums.select("day").collect())
    other = kept.select(F.col("day").alias("_day"), *[F.col(c).alias(f"_{c}") for c in ("rows", "low", "high", "mixed")])
    j = sums.join(other, F.col("day") == F.col("_day"), "full_outer")
    same = F.lit(True)
    for c in ("rows", "low", "high", "mixed"):
        same = same & F.col(c).eqNullSafe(F.col(f"_{c}"))
    return sorted(str(r[0]) for r in j.where(~same).select(F.coalesce("day", "_day").cast("string")).collect())


def kept_sums(spark: SparkSession, path: str) -> DataFrame | None:
    return V.read(spark, path) if V.current(spark, path) else None
