"""Staging projections B1-B4: 1:1 renames, casts and time-zone normalisation.

No joins or aggregates here; each function is a narrow projection that
Catalyst fuses into the scan's codegen stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import schemas
from ..functions import surrogate_key, to_utc


def _dtype(df: DataFrame, name: str) -> str:
    return df.schema[name].dataType.typeName()


def stg_foods(raw_foods: DataFrame, tz: str = "UTC", with_nutrients: bool = False) -> DataFrame:
    """B1: description/publication date out of the JSON; loaded_at to UTC.

    ``publicationDate`` is a hard cast: a malformed date fails the job, as in
    the warehouse (ANSI mode). ``with_nutrients`` keeps the parsed nutrient
    list (``food_nutrients``) as well, so that C1 need not parse again.
    """
    j = F.col("raw_json")
    # one parse of the document for all fields (string fields keep the raw
    # text of scalars, like the ->> operator)
    more = f",foodNutrients:{schemas.FOOD_NUTRIENTS_JSON}" if with_nutrients else ""
    doc = F.from_json(j, f"struct<description:string,publicationDate:string{more}>")
    return raw_foods.select(
        F.col("fdc_id"),
        F.coalesce(doc["description"], F.lit("Unknown")).alias("description"),
        doc["publicationDate"].cast("date").alias("publication_date"),
        j.alias("raw_json"),
        to_utc("loaded_at", _dtype(raw_foods, "loaded_at"), tz).alias("loaded_at"),
        *([doc["foodNutrients"].alias("food_nutrients")] if with_nutrients else []),
    )


def stg_users(raw_users: DataFrame, tz: str = "UTC") -> DataFrame:
    """B2: the name column is never projected (privacy); casts; UTC."""
    return raw_users.select(
        F.col("user_id"),
        F.col("country"),
        F.col("birth_date").cast("date").alias("birth_date"),
        F.col("height_cm").cast("double").alias("height_cm"),
        to_utc("registered_at", _dtype(raw_users, "registered_at"), tz).alias("registered_at"),
    )


def stg_weight_logs(raw_weights: DataFrame, tz: str = "UTC") -> DataFrame:
    """Normalise to UTC first, then hash (user_id, weight_kg, recorded_at)."""
    conv = raw_weights.select(
        F.col("user_id"),
        F.col("weight_kg").cast("double").alias("weight_kg"),
        to_utc("recorded_at", _dtype(raw_weights, "recorded_at"), tz).alias("recorded_at"),
    )
    return conv.select(
        surrogate_key("user_id", "weight_kg", "recorded_at").alias("weight_log_id"),
        "user_id", "weight_kg", "recorded_at",
    )


def stg_meal_logs(raw_logs: DataFrame, tz: str = "UTC") -> DataFrame:
    """NULL meal arrays become empty arrays; logged_at read in ``tz`` -> UTC."""
    empty = F.array().cast(schemas.MEAL_ITEMS)
    return raw_logs.select(
        F.col("user_id"),
        F.coalesce(F.col("breakfast"), empty).alias("breakfast"),
        F.coalesce(F.col("lunch"), empty).alias("lunch"),
        F.coalesce(F.col("dinner"), empty).alias("dinner"),
        to_utc("logged_at", _dtype(raw_logs, "logged_at"), tz).alias("logged_at"),
    )
