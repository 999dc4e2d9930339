"""Data-quality checks Q1-Q8 as Spark jobs.

Each check returns a DataFrame of failures (empty = pass), mirroring the
generic tests of the warehouse: not_null, unique, accepted_values,
relationships, accepted_range, the singular "at least one meal" test,
source freshness, and composite-grain uniqueness. ``summary`` turns a set
of checks into one (check_name, failures) table.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..sources.seeds import lookup


def null_counts(df: DataFrame, cols: Iterable[str] | None = None) -> DataFrame:
    """Q1, batched: one pass over ``df`` counting NULLs of every column.

    Returns (column_name, failures), one row per column.
    """
    cols = list(cols or df.columns)
    counts = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in cols])
    pairs = [F.struct(F.lit(c).alias("column_name"), F.col(c).alias("failures")) for c in cols]
    return counts.select(F.inline(F.array(*pairs)))


def not_null(df: DataFrame, col: str) -> DataFrame:
    """Q1: the rows whose ``col`` is NULL."""
    return df.where(F.col(col).isNull())


def unique(df: DataFrame, cols: str | list[str]) -> DataFrame:
    """Q2 / Q8: key values that occur more than once (NULL keys ignored).

    Aggregation is map-side combined, so a hot key costs one row per task.
    """
    cols = [cols] if isinstance(cols, str) else list(cols)
    cond = F.col(cols[0]).isNotNull()
    for c in cols[1:]:
        cond = cond & F.col(c).isNotNull()
    return df.where(cond).groupBy(*cols).agg(F.count(F.lit(1)).alias("n_records")).where(F.col("n_records") > 1)


def accepted_values(df: DataFrame, col: str, values: list) -> DataFrame:
    """Q3: values outside the accepted list, with their counts (NULL passes)."""
    return (df.where(~F.col(col).isin(values))
            .groupBy(F.col(col).alias("value_field")).agg(F.count(F.lit(1)).alias("n_records")))


def relationships(child: DataFrame, col: str, parent: DataFrame, field: str) -> DataFrame:
    """Q4: child rows whose non-NULL ``col`` has no parent ``field`` (anti-join)."""
    p = parent.select(F.col(field).alias("_to")).where(F.col("_to").isNotNull())
    c = child.where(F.col(col).isNotNull()).select(F.col(col).alias("from_field"))
    return c.join(p, c.from_field == p._to, "left_anti")


def accepted_range(df: DataFrame, col: str, min_value=None, max_value=None, inclusive: bool = True) -> DataFrame:
    """Q5: rows outside [min, max] (NULL passes)."""
    c = F.col(col)
    ok = F.lit(True)
    if min_value is not None:
        ok = ok & ((c >= min_value) if inclusive else (c > min_value))
    if max_value is not None:
        ok = ok & ((c <= max_value) if inclusive else (c < max_value))
    return df.where(~ok)


def range_violations(df: DataFrame, bounds: dict[str, tuple]) -> DataFrame:
    """Q5, batched: (column_name, failures) for several ranges in one pass."""
    aggs = []
    for c, (lo, hi) in bounds.items():
        x = F.col(c)
        aggs.append(F.count_if(~((x >= lo) & (x <= hi))).alias(c))
    counts = df.agg(*aggs)
    return counts.select(F.inline(F.array(*[
        F.struct(F.lit(c).alias("column_name"), F.col(c).alias("failures")) for c in bounds])))


def _empty(c: str) -> Column:
    return F.col(c).isNull() | (F.size(F.col(c)) == 0)


def no_meal_logged(meal_logs: DataFrame, meals: tuple[str, ...] = ("breakfast", "lunch", "dinner")) -> DataFrame:
    """Q6: log rows where every meal array is NULL or empty."""
    cond = _empty(meals[0])
    for m in meals[1:]:
        cond = cond & _empty(m)
    return meal_logs.where(cond).select("user_id", "logged_at")


def freshness(df: DataFrame, ts_col: str, as_of: str | Column, warn_after_h: float, error_after_h: float,
              source_name: str) -> DataFrame:
    """Q7: age of the newest row at ``as_of`` -> pass / warn / error (one row)."""
    as_of_col = F.lit(as_of).cast("timestamp_ntz") if isinstance(as_of, str) else as_of
    m = df.agg(F.max(F.col(ts_col).cast("timestamp_ntz")).alias("max_loaded_at"))
    age_h = F.timestamp_diff("SECOND", F.col("max_loaded_at"), as_of_col).cast("double") / F.lit(3600.0)
    return m.select(
        F.lit(source_name).alias("source_name"), "max_loaded_at",
        age_h.alias("age_hours"),
        F.when(F.col("max_loaded_at").isNull(), "error")
        .when(age_h > error_after_h, "error").when(age_h > warn_after_h, "warn").otherwise("pass").alias("status"),
    )


def summary(checks: dict[str, DataFrame]) -> DataFrame:
    """(check_name, failures) for a dict of failure frames, one job."""
    parts = [df.agg(F.count(F.lit(1)).alias("failures")).select(F.lit(name).alias("check_name"), "failures")
             for name, df in checks.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


# ---- Fixed values: the data tests declared on the marts (model, test, column, argument) ----
MART_TESTS = [
    ("dim_users", "unique", "user_id", None),
    ("dim_users", "not_null", "user_id", None),
    ("dim_users", "relationships", "registered_date_id", ("dim_date", "date_id")),
    ("dim_meals", "unique", "meal_id", None),
    ("dim_meals", "not_null", "meal_id", None),
    ("dim_meals", "not_null", "meal_name", None),
    ("dim_meals", "accepted_values", "meal_name", ["breakfast", "lunch", "dinner"]),
    ("dim_date", "unique", "date_id", None),
    ("dim_date", "not_null", "date_id", None),
    ("dim_date", "unique", "full_date", None),
    ("dim_date", "not_null", "full_date", None),
    ("dim_nutrients", "unique", "nutrient_id", None),
    ("dim_nutrients", "not_null", "nutrient_id", None),
    ("dim_nutrients", "unique", "usda_nutrient_id", None),
    ("dim_nutrients", "not_null", "usda_nutrient_id", None),
    ("dim_nutrients", "not_null", "nutrient_name", None),
    ("dim_nutrients", "not_null", "unit", None),
    ("fct_user_segments_windowed", "not_null", "user_id", None),
    ("fct_user_segments_windowed", "relationships", "user_id", ("dim_users", "user_id")),
    ("fct_user_segments_windowed", "not_null", "nutrient_id", None),
    ("fct_user_segments_windowed", "relationships", "nutrient_id", ("dim_nutrients", "nutrient_id")),
    ("fct_user_segments_windowed", "not_null", "reference_date", None),
    ("fct_user_segments_windowed", "accepted_values", "threshold_type", ["min", "max"]),
    ("fct_user_segments", "not_null", "user_id", None),
    ("fct_user_segments", "relationships", "user_id", ("dim_users", "user_id")),
    ("fct_user_segments", "not_null", "nutrient_id", None),
    ("fct_user_segments", "relationships", "nutrient_id", ("dim_nutrients", "nutrient_id")),
    ("fct_user_segments", "not_null", "logged_date", None),
    ("fct_user_segments", "not_null", "logged_date_id", None),
    ("fct_user_segments", "relationships", "logged_date_id", ("dim_date", "date_id")),
    ("fct_user_segments", "accepted_values", "threshold_type", ["min", "max"]),
    ("fct_bmi_evolution", "unique", "weight_log_id", None),
    ("fct_bmi_evolution", "not_null", "weight_log_id", None),
    ("fct_bmi_evolution", "not_null", "user_id", None),
    ("fct_bmi_evolution", "relationships", "user_id", ("dim_users", "user_id")),
    ("fct_bmi_evolution", "not_null", "weight_kg", None),
    ("fct_bmi_evolution", "not_null", "height_cm", None),
    ("fct_bmi_evolution", "not_null", "bmi", None),
    ("fct_bmi_evolution", "not_null", "recorded_date_id", None),
    ("fct_bmi_evolution", "relationships", "recorded_date_id", ("dim_date", "date_id")),
    ("dim_foods", "unique", "fdc_id", None),
    ("dim_foods", "not_null", "fdc_id", None),
    ("dim_foods", "not_null", "description", None),
    ("dim_foods", "relationships", "publication_date_id", ("dim_date", "date_id")),
    ("dim_foods", "accepted_range", "protein_g", (0, 100)),
    ("dim_foods", "accepted_range", "fat_g", (0, 100)),
    ("dim_foods", "accepted_range", "carbohydrate_g", (0, 100)),
    ("dim_foods", "accepted_range", "fiber_g", (0, 100)),
    ("dim_foods", "accepted_range", "total_sugar_g", (0, 100)),
    ("dim_foods", "relationships", "loaded_date_id", ("dim_date", "date_id")),
    ("fct_meal_logs", "not_null", "user_id", None),
    ("fct_meal_logs", "relationships", "user_id", ("dim_users", "user_id")),
    ("fct_meal_logs", "not_null", "meal_id", None),
    ("fct_meal_logs", "relationships", "meal_id", ("dim_meals", "meal_id")),
    ("fct_meal_logs", "not_null", "fdc_id", None),
    ("fct_meal_logs", "relationships", "fdc_id", ("dim_foods", "fdc_id")),
    ("fct_meal_logs", "not_null", "grams", None),
    ("fct_meal_logs", "accepted_range", "grams", (0, 1000)),
    ("fct_meal_logs", "not_null", "logged_date", None),
    ("fct_meal_logs", "not_null", "logged_date_id", None),
    ("fct_meal_logs", "relationships", "logged_date_id", ("dim_date", "date_id")),
    ("fct_meal_log_nutrients", "not_null", "user_id", None),
    ("fct_meal_log_nutrients", "relationships", "user_id", ("dim_users", "user_id")),
    ("fct_meal_log_nutrients", "not_null", "meal_id", None),
    ("fct_meal_log_nutrients", "relationships", "meal_id", ("dim_meals", "meal_id")),
    ("fct_meal_log_nutrients", "not_null", "nutrient_id", None),
    ("fct_meal_log_nutrients", "relationships", "nutrient_id", ("dim_nutrients", "nutrient_id")),
    ("fct_meal_log_nutrients", "not_null", "logged_date", None),
    ("fct_meal_log_nutrients", "not_null", "logged_date_id", None),
    ("fct_meal_log_nutrients", "relationships", "logged_date_id", ("dim_date", "date_id")),
]
# -----------------------------------------------------------------------------------------------


# ---- Fixed values: the data tests declared on the sources, staging and intermediate models ----
# (model names are this library's Warehouse attributes)
MODEL_TESTS = [
    ("raw_foods", "unique", "fdc_id", None),
    ("raw_foods", "not_null", "fdc_id", None),
    ("raw_foods", "not_null", "loaded_at", None),
    ("raw_meal_logs", "not_null", "user_id", None),
    ("raw_meal_logs", "not_null", "logged_at", None),
    ("raw_users", "unique", "user_id", None),
    ("raw_users", "not_null", "user_id", None),
    ("raw_users", "not_null", "user_name", None),
    ("raw_users", "not_null", "country", None),
    ("raw_users", "not_null", "birth_date", None),
    ("raw_users", "not_null", "height_cm", None),
    ("raw_users", "not_null", "registered_at", None),
    ("raw_weights", "not_null", "user_id", None),
    ("raw_weights", "relationships", "user_id", ("raw_users", "user_id")),
    ("raw_weights", "not_null", "weight_kg", None),
    ("raw_weights", "accepted_range", "weight_kg", (30, 500)),
    ("raw_weights", "not_null", "recorded_at", None),
    ("stg_users", "unique", "user_id", None),
    ("stg_users", "not_null", "user_id", None),
    ("stg_users", "not_null", "country", None),
    ("stg_users", "accepted_values", "country", ["Spain"]),
    ("stg_users", "not_null", "birth_date", None),
    ("stg_users", "not_null", "height_cm", None),
    ("stg_users", "not_null", "registered_at", None),
    ("stg_weights", "unique", "weight_log_id", None),
    ("stg_weights", "not_null", "weight_log_id", None),
    ("stg_weights", "not_null", "user_id", None),
    ("stg_weights", "not_null", "weight_kg", None),
    ("stg_weights", "not_null", "recorded_at", None),
    ("stg_meal_logs", "not_null", "user_id", None),
    ("stg_meal_logs", "not_null", "logged_at", None),
    ("stg_foods", "unique", "fdc_id", None),
    ("stg_foods", "not_null", "fdc_id", None),
    ("stg_foods", "unique", "description", None),
    ("stg_foods", "not_null", "description", None),
    ("stg_foods", "not_null", "publication_date", None),
    ("stg_foods", "not_null", "raw_json", None),
    ("stg_foods", "not_null", "loaded_at", None),
    ("users_bmi", "unique", "user_id", None),
    ("users_bmi", "not_null", "user_id", None),
    ("segments", "not_null", "user_id", None),
    ("segments", "not_null", "nutrient_id", None),
    ("segments", "not_null", "logged_date", None),
    ("segments", "not_null", "logged_date_id", None),
    ("windowed", "not_null", "user_id", None),
    ("windowed", "not_null", "nutrient_id", None),
    ("windowed", "not_null", "reference_date", None),
    ("food_nutrients", "unique", "fdc_id", None),
    ("food_nutrients", "not_null", "fdc_id", None),
    ("daily_intake", "not_null", "user_id", None),
    ("daily_intake", "not_null", "nutrient_id", None),
    ("daily_intake", "not_null", "logged_date", None),
    ("daily_intake", "not_null", "logged_date_id", None),
    ("scaled", "not_null", "user_id", None),
    ("scaled", "not_null", "meal_id", None),
    ("scaled", "not_null", "logged_date", None),
    ("scaled", "not_null", "logged_date_id", None),
    ("bmi_history", "unique", "weight_log_id", None),
    ("bmi_history", "not_null", "weight_log_id", None),
    ("bmi_history", "not_null", "user_id", None),
    ("bmi_history", "not_null", "weight_kg", None),
    ("bmi_history", "not_null", "height_cm", None),
    ("bmi_history", "not_null", "bmi", None),
    ("bmi_history", "not_null", "recorded_date_id", None),
    ("items", "not_null", "user_id", None),
    ("items", "not_null", "meal_id", None),
    ("items", "accepted_values", "meal_id", [1, 2, 3]),
    ("items", "not_null", "fdc_id", None),
    ("items", "not_null", "grams", None),
    ("items", "accepted_range", "grams", (0, 1000)),
    ("items", "not_null", "logged_date", None),
    ("items", "not_null", "logged_date_id", None),
]
# ----------------------------------------------------------------------------------------


# ---- Fixed values: the data tests declared on the literal lookup seeds ----
SEED_TESTS = [
    ("meals", "unique", "meal_id", None),
    ("meals", "not_null", "meal_id", None),
    ("meals", "unique", "meal_name", None),
    ("meals", "not_null", "meal_name", None),
    ("meals", "accepted_values", "meal_name", ["breakfast", "lunch", "dinner"]),
    ("bmi_categories", "unique", "bmi_category_id", None),
    ("bmi_categories", "not_null", "bmi_category_id", None),
    ("bmi_categories", "not_null", "category", None),
    ("nutrient_daily_targets", "unique", "nutrient_id", None),
    ("nutrient_daily_targets", "not_null", "nutrient_id", None),
    ("nutrient_daily_targets", "not_null", "recommended_daily_g", None),
    ("nutrient_daily_targets", "not_null", "threshold_type", None),
    ("nutrient_daily_targets", "accepted_values", "threshold_type", ["min", "max", "target"]),
    ("nutrients", "unique", "nutrient_id", None),
    ("nutrients", "not_null", "nutrient_id", None),
    ("nutrients", "unique", "usda_nutrient_id", None),
    ("nutrients", "not_null", "usda_nutrient_id", None),
    ("nutrients", "not_null", "nutrient_name", None),
    ("nutrients", "not_null", "unit", None),
]
# ----------------------------------------------------------------------------


# ---- Fixed values: the data tests declared on the SCD2 snapshot ----
SNAPSHOT_TESTS = [
    ("dim_foods_snapshot", "unique", "dbt_scd_id", None),
    ("dim_foods_snapshot", "not_null", "dbt_scd_id", None),
    ("dim_foods_snapshot", "not_null", "fdc_id", None),
    ("dim_foods_snapshot", "not_null", "dbt_valid_from", None),
]
# ---------------------------------------------------------------------


def test_name(model: str, test: str, column: str) -> str:
    return f"{test}__{model}__{column}"


def mart_tests(marts: dict[str, DataFrame], tests: list[tuple] | None = None) -> DataFrame:
    """Run declared data tests over (materialised) marts: (test_name, failures).

    failures = failing rows for not_null / relationships / accepted_range, and
    failing key values (groups) for unique / accepted_values, as the generic
    tests report them. Per model, all row-level and relationship tests are
    counted in one pass (the model left-joined to the distinct keys of each
    referenced parent); unique / accepted_values are one grouping each.
    """
    tests = tests or MART_TESTS
    per_model: dict[str, list[tuple]] = {}
    for t in tests:
        per_model.setdefault(t[0], []).append(t)
    parts, parents = [], {}
    for model, ts in per_model.items():
        df = marts[model]
        conds = []
        for i, (_, test, column, arg) in enumerate(ts):
            c = F.col(column)
            if test == "not_null":
                conds.append((test_name(model, test, column), c.isNull()))
            elif test == "accepted_range":
                conds.append((test_name(model, test, column), ~((c >= arg[0]) & (c <= arg[1]))))
            elif test == "relationships":
                key = f"_parent{i}"
                if (arg[0], arg[1]) not in parents:  # distinct keys of a parent, once for all its children
                    parents[arg[0], arg[1]] = lookup(
                        marts[arg[0]].select(F.col(arg[1]).alias("_k")).where(F.col("_k").isNotNull()).distinct())
                df = df.join(parents[arg[0], arg[1]].withColumnRenamed("_k", key), c == F.col(key), "left")
                conds.append((test_name(model, test, column), c.isNotNull() & F.col(key).isNull()))
            elif test == "unique":
                parts.append(unique(marts[model], column).agg(F.count(F.lit(1)).alias("failures"))
                             .select(F.lit(test_name(model, test, column)).alias("check_name"), "failures"))
            elif test == "accepted_values":
                parts.append(accepted_values(marts[model], column, arg).agg(F.count(F.lit(1)).alias("failures"))
                             .select(F.lit(test_name(model, test, column)).alias("check_name"), "failures"))
            else:
                raise ValueError(test)
        if conds:
            counts = df.agg(*[F.count_if(cond).alias(f"c{j}") for j, (_, cond) in enumerate(conds)])
            parts.append(counts.select(F.inline(F.array(*[
                F.struct(F.lit(name).alias("check_name"), F.col(f"c{j}").alias("failures"))
                for j, (name, _) in enumerate(conds)]))))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.select(F.col("check_name").alias("test_name"), "failures")
