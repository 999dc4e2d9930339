"""Column -> Column helpers (the warehouse's macros and scalar rules).

Everything here is a plain expression builder: it returns a ``Column`` that
Catalyst compiles into the surrounding whole-stage-codegen span. No UDFs.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType

# Per-100 g nutrient amounts are parsed as exact decimals: ten digits before
# and ten after the point. Servings have nine and six. Their products fit
# DECIMAL(38,18) exactly.
AMOUNT_TYPE = DecimalType(20, 10)
PER_GRAM_TYPE = DecimalType(22, 12)
GRAMS_TYPE = DecimalType(15, 6)

# Fixed value: the null placeholder used by the public surrogate-key macro,
# so that keys built here equal keys built by the warehouse.
SURROGATE_NULL = "_dbt_utils_surrogate_key_null_"


def col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def date_id(d: str | Column) -> Column:
    """YYYYMMDD integer surrogate key of a date."""
    d = col(d)
    return (F.year(d) * 10000 + F.month(d) * 100 + F.dayofmonth(d)).cast("int")


def round_half_away(c: str | Column, digits: int) -> Column:
    """Round a DOUBLE the way the warehouse engine does: ``round(x*10^n)/10^n``.

    Spark's ``round(double, n)`` rounds the shortest decimal string of the
    double, so ``round(1.005, 2)`` gives 1.01; the warehouse gives 1.0 (F9).
    Rounding at scale 0 agrees in both engines, so scale first.
    """
    scale = 10 ** digits
    return F.round(col(c).cast("double") * F.lit(float(scale))) / F.lit(float(scale))


def round_exact(c: str | Column, digits: int) -> Column:
    """HALF_UP rounding of an exact DECIMAL value."""
    return F.round(col(c), digits)


def bmi(weight_kg: str | Column, height_cm: str | Column) -> Column:
    """``round(weight / (height/100)^2, 1)`` (U1). Zero height gives NULL."""
    h = col(height_cm).cast("double") / F.lit(100.0)
    return round_half_away(F.try_divide(col(weight_kg).cast("double"), F.pow(h, F.lit(2.0))), 1)


def per_gram(amount_per_100g: str | Column) -> Column:
    """Exact nutrient grams per gram of food."""
    return (col(amount_per_100g).cast(AMOUNT_TYPE) * F.lit(Decimal("0.01"))).cast(PER_GRAM_TYPE)


def scaled_grams(amount_per_gram: str | Column, grams: str | Column) -> Column:
    """Exact nutrient grams of one item, DECIMAL(38,18): no digit is lost, and sums of such values do not depend
    on the order in which executors add them (20 digits before the point)."""
    return col(amount_per_gram).cast(PER_GRAM_TYPE) * col(grams).cast(GRAMS_TYPE)


def exact_avg(c: str | Column) -> Column:
    """Average of an exact column as DOUBLE: ``double(sum) / count`` (nulls skipped)."""
    c = col(c)
    return F.try_divide(F.sum(c).cast("double"), F.count(c).cast("double"))


def avg_round2(c: str | Column) -> Column:
    return round_half_away(exact_avg(c), 2)


def surrogate_key(*cols: str | Column) -> Column:
    """md5 of the '-'-joined string forms, NULL replaced by a fixed token."""
    parts = [F.coalesce(col(c).cast("string"), F.lit(SURROGATE_NULL)) for c in cols]
    return F.md5(F.concat_ws("-", *parts))


def naive_to_utc(ts: str | Column, tz: str) -> Column:
    """Wall-clock timestamp read in ``tz`` -> UTC wall clock (TIMESTAMP_NTZ)."""
    return F.convert_timezone(F.lit(tz), F.lit("UTC"), col(ts).cast("timestamp_ntz"))


def instant_to_utc(ts: str | Column) -> Column:
    """Instant (TIMESTAMP) -> UTC wall clock, whatever the session time zone."""
    return F.convert_timezone(F.current_timezone(), F.lit("UTC"), col(ts).cast("timestamp_ntz"))


def to_utc(ts: str | Column, dtype_name: str, tz: str) -> Column:
    """Normalise a timestamp column to UTC wall clock.

    ``dtype_name`` is the column's Spark type name: instants are converted
    exactly; naive values are read in ``tz`` (the warehouse session zone).
    """
    if dtype_name == "timestamp":
        return instant_to_utc(ts)
    return naive_to_utc(ts, tz)


def week_start(d: str | Column) -> Column:
    """Monday of the ISO week, as DATE."""
    return F.trunc(col(d), "week")


def month_start(d: str | Column) -> Column:
    return F.trunc(col(d), "month")


def week_label(d: str | Column) -> Column:
    """``strftime('%Y-W%W')``: Monday-first week number, days before the
    first Monday are week 00 (not ISO) (D12)."""
    d = col(d)
    wk = F.floor((F.dayofyear(d) + F.lit(6) - F.weekday(d)) / F.lit(7)).cast("int")
    return F.concat(F.year(d).cast("string"), F.lit("-W"), F.lpad(wk.cast("string"), 2, "0"))


def month_label(d: str | Column) -> Column:
    """``strftime('%b %Y')`` e.g. 'Jan 2024' (D12)."""
    return F.date_format(col(d), "MMM yyyy")


def threshold_flag(threshold_type: str | Column, value: Column, threshold: Column) -> Column:
    """min -> value below threshold; max -> above; anything else NULL."""
    t = col(threshold_type)
    return F.when(t == "min", value < threshold).when(t == "max", value > threshold)


__all__ = [
    "AMOUNT_TYPE", "SURROGATE_NULL", "date_id", "round_half_away", "round_exact",
    "bmi", "exact_avg", "avg_round2", "surrogate_key", "naive_to_utc",
    "instant_to_utc", "to_utc", "week_start", "month_start", "week_label", "month_label",
    "GRAMS_TYPE", "per_gram", "scaled_grams",
    "threshold_flag",
]
