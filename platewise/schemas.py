"""Declared schemas of the raw tables and seeds (A5, §1)."""

from pyspark.sql.types import (
    ArrayType, DateType, DoubleType, IntegerType, LongType, StringType, StructField, StructType,
    TimestampNTZType, TimestampType,
)

MEAL_ITEM = StructType([
    StructField("fdc_id", LongType(), True),
    StructField("grams", DoubleType(), True),
])
MEAL_ITEMS = ArrayType(MEAL_ITEM, True)

# Nested food-JSON element: strings on purpose, `amount` may be text ("n/a").
FOOD_NUTRIENTS_JSON = "array<struct<number:string,amount:string>>"

RAW_FOODS = StructType([
    StructField("fdc_id", LongType(), False),
    StructField("loaded_at", TimestampType(), False),
    StructField("raw_json", StringType(), True),
])

RAW_MEAL_LOGS = StructType([
    StructField("user_id", LongType(), False),
    StructField("breakfast", MEAL_ITEMS, True),
    StructField("lunch", MEAL_ITEMS, True),
    StructField("dinner", MEAL_ITEMS, True),
    StructField("logged_at", TimestampNTZType(), False),
])

USERS = StructType([
    StructField("user_id", LongType(), False),
    StructField("user_name", StringType(), True),
    StructField("country", StringType(), True),
    StructField("birth_date", DateType(), True),
    StructField("height_cm", DoubleType(), True),
    StructField("registered_at", TimestampType(), True),
])

WEIGHT_LOGS = StructType([
    StructField("user_id", LongType(), False),
    StructField("weight_kg", DoubleType(), True),
    StructField("recorded_at", TimestampType(), True),
])

MEALS = StructType([
    StructField("meal_id", IntegerType(), False),
    StructField("meal_name", StringType(), False),
])

NUTRIENTS = StructType([
    StructField("nutrient_id", IntegerType(), False),
    StructField("usda_nutrient_id", IntegerType(), False),
    StructField("nutrient_name", StringType(), False),
    StructField("unit", StringType(), False),
])

BMI_CATEGORIES = StructType([
    StructField("bmi_category_id", IntegerType(), False),
    StructField("min_bmi", DoubleType(), True),
    StructField("max_bmi", DoubleType(), True),
    StructField("category", StringType(), False),
])

NUTRIENT_DAILY_TARGETS = StructType([
    StructField("nutrient_id", IntegerType(), False),
    StructField("recommended_daily_g", DoubleType(), False),
    StructField("threshold_type", StringType(), False),
    StructField("segment_label", StringType(), True),
    StructField("source", StringType(), True),
    StructField("notes", StringType(), True),
])

SEED_SCHEMAS = {
    "users": USERS,
    "weight_logs": WEIGHT_LOGS,
    "meals": MEALS,
    "nutrients": NUTRIENTS,
    "bmi_categories": BMI_CATEGORIES,
    "nutrient_daily_targets": NUTRIENT_DAILY_TARGETS,
}
