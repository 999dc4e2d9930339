"""Raw tables: declared creation (A5), key scan (A6), daily/historic loads (A2/A3)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schemas

RAW_TABLES = {"raw_foods": schemas.RAW_FOODS, "raw_meal_logs": schemas.RAW_MEAL_LOGS}


def create_raw_tables(spark: SparkSession, root: str) -> dict[str, str]:
    """A5: create each raw table (empty, declared schema) unless it exists."""
    paths = {}
    for name, schema in RAW_TABLES.items():
        path = f"{root.rstrip('/')}/{name}"
        spark.createDataFrame([], schema).write.mode("ignore").parquet(path)
        paths[name] = path
    return paths


def read_raw(spark: SparkSession, path: str, name: str) -> DataFrame:
    """Read a raw table with its declared schema (no inference)."""
    return spark.read.schema(RAW_TABLES[name]).parquet(path)


def food_ids(raw_foods: DataFrame) -> DataFrame:
    """The valid food keys (distinct, map-side combined)."""
    return raw_foods.select("fdc_id").where(F.col("fdc_id").isNotNull()).distinct()


def load_daily_meal_logs(logs: DataFrame, path: str) -> None:
    """A2: the daily feed replaces the raw table (idempotent re-run)."""
    logs.select(*schemas.RAW_MEAL_LOGS.fieldNames()).write.mode("overwrite").parquet(path)


def load_historic_meal_logs(logs: DataFrame, path: str) -> None:
    """A3: history is appended (no truncation; not safe to re-run)."""
    logs.select(*schemas.RAW_MEAL_LOGS.fieldNames()).write.mode("append").parquet(path)
