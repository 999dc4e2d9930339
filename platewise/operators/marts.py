"""Mart operators M1-M10: dimensions and facts of the star schema.

Facts keep their nutrient values as exact DECIMALs so that every report
re-aggregating them (daily sums, weekly/monthly averages) is exact; the
double-typed view of a mart is ``as_double(df)``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType, StructType

from ..functions import date_id, round_half_away
from ..functions import grams as G
from ..sources import seeds
from . import transforms as T

DIM_DATE_START = "2019-01-01"
DIM_DATE_END = "2027-12-31"


def as_double(df: DataFrame) -> DataFrame:
    """Cast every DECIMAL or gram column to DOUBLE (presentation / exchange form)."""
    return df.select(*[F.col(f.name).cast("double").alias(f.name) if isinstance(f.dataType, DecimalType)
                       else G.to_double(f.name).alias(f.name) if isinstance(f.dataType, StructType)
                       else F.col(f.name) for f in df.schema.fields])


# ------------------------------------------------------------------------ M1
def _as_date(v: Column | str) -> Column:
    return F.lit(v).cast("date") if isinstance(v, str) else v.cast("date")


def dim_date(spark: SparkSession, start: Column | str = DIM_DATE_START, end: Column | str = DIM_DATE_END,
             end_inclusive: bool = False) -> DataFrame:
    """M1: date spine with calendar attributes.

    The public spine macro treats ``end`` as exclusive (last day 2027-12-30
    for the defaults); ``end_inclusive=True`` gives the documented range.
    Bounds may be Columns (e.g. scalar subqueries over a fact table).
    One row per day: a century is 36,525 rows, so the spine is generated in
    a single task and then joined by date_id.
    """
    s, e = _as_date(start), _as_date(end)
    last = e if end_inclusive else F.date_sub(e, 1)
    spine = spark.range(0, 1, 1, 1).select(F.explode(F.sequence(s, last)).alias("date_day")).where(
        F.col("date_day").isNotNull())
    d = F.col("date_day")
    dow = (F.dayofweek(d) - 1).cast("int")
    return spine.select(
        date_id(d).alias("date_id"),
        d.alias("full_date"),
        F.year(d).cast("int").alias("year"),
        F.quarter(d).cast("int").alias("quarter"),
        F.month(d).cast("int").alias("month"),
        F.date_format(d, "MMMM").alias("month_name"),
        F.weekofyear(d).cast("int").alias("week_of_year"),
        F.dayofmonth(d).cast("int").alias("day_of_month"),
        dow.alias("day_of_week"),
        F.date_format(d, "EEEE").alias("day_name"),
        dow.isin(0, 6).alias("is_weekend"),
    )


# ------------------------------------------------------------------------ M2
def dim_users(users_bmi: DataFrame, personal_per_kg: float = 0.8) -> DataFrame:
    """M2: user profile with recommended protein; age is left to query time."""
    return users_bmi.select(
        "user_id", "country", "birth_date", "weight_kg", "height_cm", "bmi", "bmi_category",
        round_half_away(F.col("weight_kg") * F.lit(personal_per_kg), 1).alias("recommended_protein_g"),
        "registered_date_id",
    )


# ------------------------------------------------------------------- M3 / M4
def dim_meals(meals: DataFrame) -> DataFrame:
    return meals.select("meal_id", "meal_name")


def dim_nutrients(nutrients: DataFrame) -> DataFrame:
    return nutrients.select("nutrient_id", "usda_nutrient_id", "nutrient_name", "unit")


# ------------------------------------------------------------------------ M5
def dim_foods(food_nutrients: DataFrame) -> DataFrame:
    """M5: one row per food, nutrients per 100 g."""
    return food_nutrients.select("fdc_id", "description", "publication_date_id", "loaded_date_id",
                                 *T.NUTRIENTS)


# ------------------------------------------------------------------------ M6
def fct_meal_logs(items: DataFrame) -> DataFrame:
    """M6: one row per logged item (user x meal x food x day)."""
    return items.select("user_id", "meal_id", "fdc_id", "grams", "logged_date", "logged_date_id")


# ------------------------------------------------------------------------ M7
def fct_meal_log_nutrients(scaled: DataFrame) -> DataFrame:
    """M7: per user, meal and day, each nutrient's grams, in long form.

    Five sums are aggregated first, then one Generate emits the five rows.
    ``value_g`` is exact, in the form of ``scaled``.
    """
    keys = ["user_id", "meal_id", "logged_date", "logged_date_id"]
    return T.to_long(T.grouped_grams(scaled, keys), keys, "value_g").select(
        "user_id", "meal_id", "nutrient_id", "logged_date", "logged_date_id", "value_g")


# ---------------------------------------------------------------- M8 - M10
def fct_bmi_evolution(bmi_history: DataFrame) -> DataFrame:
    return bmi_history.select("weight_log_id", "user_id", "weight_kg", "height_cm", "bmi",
                              "recorded_date_id")


def fct_user_segments(segments: DataFrame) -> DataFrame:
    return segments.select("user_id", "nutrient_id", "logged_date", "logged_date_id", "daily_value_g",
                           "threshold_g", "threshold_type", "segment_label", "is_flagged")


def fct_user_segments_windowed(windowed: DataFrame) -> DataFrame:
    return windowed.select("user_id", "nutrient_id", "reference_date", "last_day_g", "last_7d_avg_g",
                           "last_30d_avg_g", "threshold_g", "threshold_type", "segment_label",
                           "is_flagged_last_day", "is_flagged_last_7d", "is_flagged_last_30d")


def seed_dims(spark: SparkSession) -> dict[str, DataFrame]:
    return {"dim_meals": dim_meals(seeds.meals(spark)), "dim_nutrients": dim_nutrients(seeds.nutrients(spark))}
