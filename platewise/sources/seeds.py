"""Seed lookups (A4): literal frames and a CSV reader with declared schemas.

The literal frames are tiny and fixed (3, 5, 4 and 5 rows). ``lookup`` hints a
broadcast only after checking a lookup table's size.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from .. import schemas

# ---- Fixed values: they must equal the warehouse seeds for equal results ----
MEALS = [
    (1, "breakfast"),
    (2, "lunch"),
    (3, "dinner"),
]
NUTRIENTS = [
    (1, 203, "Protein", "g"),
    (2, 204, "Fat", "g"),
    (3, 205, "Carbohydrate", "g"),
    (4, 291, "Fiber", "g"),
    (5, 269, "Total Sugar", "g"),
]
BMI_CATEGORIES = [
    (1, 0.0, 18.5, "Underweight"),
    (2, 18.5, 25.0, "Normal weight"),
    (3, 25.0, 30.0, "Overweight"),
    (4, 30.0, 999.0, "Obese"),
]
NUTRIENT_DAILY_TARGETS = [
    (1, 50.0, "min", "low_protein", "FDA", "Based on 2000 calorie diet - overridden per user by weight x 0.8"),
    (2, 78.0, "max", "high_fat", "FDA", "Based on 2000 calorie diet"),
    (3, 275.0, "max", None, "FDA", "Based on 2000 calorie diet - treated as max (not a true target range) for simplicity, since no carb segment is defined"),  # noqa: E501
    (4, 28.0, "min", "low_fiber", "FDA", "Based on 2000 calorie diet"),
    (5, 50.0, "max", "high_sugar", "WHO", "Less than 10% of daily energy intake"),
]
# USDA nutrient number -> wide column, in nutrient_id order 1..5.
NUTRIENT_COLUMNS = [
    ("203", "protein_g"),
    ("204", "fat_g"),
    ("205", "carbohydrate_g"),
    ("291", "fiber_g"),
    ("269", "total_sugar_g"),
]
# Personalised thresholds: nutrient_id -> grams per kg body weight.
PERSONAL_TARGETS = {1: 0.8}
# Source freshness policies: (warn, error) in hours.
FRESHNESS_MEAL_LOGS_H = (12, 25)
FRESHNESS_FOODS_H = (30 * 24, 60 * 24)
# ------------------------------------------------------------------------------

NUTRIENT_VALUE_COLUMNS = [c for _, c in NUTRIENT_COLUMNS]


def literal_frame(spark: SparkSession, rows: list[tuple], schema: StructType) -> DataFrame:
    """A small literal table built JVM-side (folded to a LocalRelation by the
    optimizer): no Python worker is needed to read it, and its exact size is
    known to the planner."""
    values = ", ".join("(" + ", ".join(_sql_literal(v) for v in row) + ")" for row in rows)
    names = [f"c{i}" for i in range(len(schema.fields))]
    cols = ", ".join(f"CAST({n} AS {f.dataType.simpleString()}) AS {f.name}" for n, f in zip(names, schema.fields))
    return spark.sql(f"SELECT {cols} FROM VALUES {values} AS t({', '.join(names)})")


def _sql_literal(v) -> str:
    if v is None:
        return "NULL"
    if isinstance(v, bool):
        return "TRUE" if v else "FALSE"
    if isinstance(v, int):
        return str(v)
    if isinstance(v, float):
        return repr(v) + "D"
    s = str(v).replace("\\", "\\\\").replace("'", "\\'")
    return f"'{s}'"


def meals(spark: SparkSession) -> DataFrame:
    return literal_frame(spark, MEALS, schemas.MEALS)


def nutrients(spark: SparkSession) -> DataFrame:
    return literal_frame(spark, NUTRIENTS, schemas.NUTRIENTS)


def bmi_categories(spark: SparkSession) -> DataFrame:
    return literal_frame(spark, BMI_CATEGORIES, schemas.BMI_CATEGORIES)


def nutrient_daily_targets(spark: SparkSession) -> DataFrame:
    return literal_frame(spark, NUTRIENT_DAILY_TARGETS, schemas.NUTRIENT_DAILY_TARGETS)


def read_seed_csv(spark: SparkSession, path: str, name: str) -> DataFrame:
    """Read a header CSV seed with its declared schema (no inference).

    Quoted commas are honoured; an empty field becomes NULL; timestamps with
    an offset (``2026-05-01 09:23:14+02:00``) parse to instants.
    """
    schema = schemas.SEED_SCHEMAS[name]
    return (spark.read.schema(schema)
            .option("header", True)
            .option("timestampFormat", "yyyy-MM-dd HH:mm:ss[XXX]")
            .option("mode", "FAILFAST")
            .csv(path))


# A lookup side is broadcast up to this many bytes (rows times row width).
LOOKUP_MAX_BYTES = 16 << 20
# Width assumed of a string, binary or nested value.
WIDE_VALUE_BYTES = 128


# size proofs of lookup frames built from literals only (no input files):
# their content cannot change, so one bounded count per distinct plan suffices
_PROVEN: dict[tuple[int, int], bool] = {}


def row_bytes(df: DataFrame) -> int:
    """Estimated width of a row: 16 bytes per fixed-size value, more for others."""
    fixed = {"int", "bigint", "smallint", "tinyint", "double", "float", "boolean", "date", "timestamp", "timestamp_ntz"}
    return sum(16 if t in fixed or t.startswith("decimal") else WIDE_VALUE_BYTES for _, t in df.dtypes)


def lookup(df: DataFrame, max_bytes: int = LOOKUP_MAX_BYTES) -> DataFrame:
    """Broadcast a lookup side only behind a size check.

    A bounded count (it reads one row more than fit ``max_bytes``) proves the
    bound; a larger table is returned as is, so the planner picks a shuffle
    join for it, with the same answer. Frames that read no files (literal
    seeds, the date spine) are counted once per distinct plan; file-backed
    lookups are counted on every call.
    """
    most = max(1, max_bytes // row_bytes(df))
    if df.inputFiles():
        small = df.limit(most + 1).count() <= most
    else:
        key = (df.semanticHash(), most)
        if key not in _PROVEN:
            _PROVEN[key] = df.limit(most + 1).count() <= most
        small = _PROVEN[key]
    return F.broadcast(df) if small else df
