"""Reporting queries R1-R10 over the marts.

Each report is a function of mart DataFrames. Lookups (nutrient names,
meal names) are seed-sized and broadcast; two-level aggregates shuffle the
fact once on the daily grain and then only the much smaller daily rows.
Optional ``ordered=False`` skips the final global sort when the caller only
writes the result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import avg_round2, month_start, round_half_away, week_start
from ..functions import grams as G
from ..operators import transforms as T
from ..sources.seeds import lookup


def _sorted(df: DataFrame, ordered: bool, *cols) -> DataFrame:
    return df.orderBy(*cols) if ordered else df


def daily_totals(fct_mln: DataFrame | None, daily: DataFrame | None = None) -> DataFrame:
    """Daily totals per user and nutrient (exact): the first level of every
    intake report. Pass ``daily`` when it is already at hand (e.g. computed
    from scaled items, one shuffle less than re-aggregating the meal fact)."""
    if daily is not None:
        return daily
    return fct_mln.groupBy("user_id", "nutrient_id", "logged_date", "logged_date_id").agg(
        F.sum("value_g").alias("daily_value_g"))


def _names(dim_nutrients: DataFrame) -> DataFrame:
    """Nutrient names (unique per nutrient_id in the dimension), broadcast."""
    return lookup(dim_nutrients.select("nutrient_id", "nutrient_name"))


def mean2(df: DataFrame, value: str) -> Column:
    """Aggregate: the average of an exact column, rounded to two decimals."""
    return G.average2(G.total(value), F.count_if(G.known(value))) if G.is_grams(df, value) else avg_round2(value)


def as_double(df: DataFrame, value: str) -> Column:
    return G.to_double(value) if G.is_grams(df, value) else F.col(value).cast("double")


def daily_intake_report(fct_mln: DataFrame | None, dim_nutrients: DataFrame, ordered: bool = True,
                        daily: DataFrame | None = None) -> DataFrame:
    """Grams per nutrient per user per day, summed across meals."""
    d = daily_totals(fct_mln, daily)
    out = d.join(_names(dim_nutrients), "nutrient_id", "inner").select(
        "user_id", "nutrient_name", "logged_date", as_double(d, "daily_value_g").alias("daily_value_g"))
    return _sorted(out, ordered, "logged_date", "user_id", "nutrient_name")


def weekly_average_report(fct_mln: DataFrame | None, dim_nutrients: DataFrame, ordered: bool = True,
                          daily: DataFrame | None = None) -> DataFrame:
    """R2: average daily intake per ISO week (Monday start)."""
    d = daily_totals(fct_mln, daily).join(_names(dim_nutrients), "nutrient_id")
    out = d.groupBy("user_id", "nutrient_id", "nutrient_name", week_start("logged_date").alias("week_start")).agg(
        mean2(d, "daily_value_g").alias("weekly_avg_g")).select(
        "user_id", "nutrient_name", "week_start", "weekly_avg_g")
    return _sorted(out, ordered, "week_start", "user_id", "nutrient_name")


def monthly_rollup(daily: DataFrame, keys: list[str]) -> DataFrame:
    return daily.groupBy(*keys, month_start("logged_date").alias("month_start")).agg(
        mean2(daily, "daily_value_g").alias("monthly_avg_g"))


def _monthly_wide(wide: DataFrame) -> DataFrame:
    """Long rows of every user, month and nutrient with the average and that of the user's month before, out of wide days:
    one row per user and month is moved for all nutrients."""
    months = wide.select("user_id", month_start("logged_date").alias("month_start"), *T.NUTRIENTS)
    sums = G.totals(months, ["user_id", "month_start"], T.NUTRIENTS, *[F.count_if(G.known(n)).alias(f"n_{n}") for n in T.NUTRIENTS])
    m = sums.select("user_id", "month_start", F.zip_with("_totals", F.array(*[f"n_{n}" for n in T.NUTRIENTS]), G.average2).alias("_avg"))
    before = m.withColumn("_prev", F.lag("_avg").over(Window.partitionBy("user_id").orderBy("month_start")))
    return before.select("user_id", "month_start", F.inline(F.array(*[
        F.struct(F.lit(k + 1).alias("nutrient_id"), F.get("_avg", F.lit(k)).alias("monthly_avg_g"),
                 F.get("_prev", F.lit(k)).alias("prev_month_avg_g")) for k in range(len(T.NUTRIENTS))])))


def monthly_mom_report(fct_mln: DataFrame | None, dim_nutrients: DataFrame, ordered: bool = True,
                       daily: DataFrame | None = None, wide: DataFrame | None = None) -> DataFrame:
    """Monthly average, previous month's average and the delta (of rounded values). ``wide``: days in wide gram rows."""
    if wide is not None:
        m = _monthly_wide(wide)
    else:
        prev = F.lag("monthly_avg_g").over(Window.partitionBy("user_id", "nutrient_id").orderBy("month_start"))
        m = monthly_rollup(daily_totals(fct_mln, daily), ["user_id", "nutrient_id"]).withColumn("prev_month_avg_g", prev)
    out = m.join(_names(dim_nutrients), "nutrient_id").select(
        "user_id", "nutrient_name", "month_start", "monthly_avg_g", "prev_month_avg_g",
        round_half_away(F.col("monthly_avg_g") - F.col("prev_month_avg_g"), 2).alias("mom_delta_g"))
    return _sorted(out, ordered, "user_id", "nutrient_name", "month_start")


def rolling_average(value: str, partition: list[str], order: str, rows: int = 7, exact: bool = False) -> Column:
    """Average over the last ``rows`` logged rows (ROWS frame, not calendar days); ``exact`` for a gram column."""
    w = Window.partitionBy(*partition).orderBy(order).rowsBetween(-(rows - 1), 0)
    if exact:
        return G.average2(F.get(F.transform(F.array(G.running_parts(value, w)), G.folded), F.lit(0)),
                          F.count(F.when(G.known(value), 1)).over(w))
    return round_half_away(F.try_divide(F.sum(value).over(w).cast("double"),
                                        F.count(value).over(w).cast("double")), 2)


def rolling_report(fct_mln: DataFrame | None, dim_nutrients: DataFrame, dim_date: DataFrame,
                   ordered: bool = True, daily: DataFrame | None = None) -> DataFrame:
    """Daily series with calendar attributes and a 7-row rolling average.

    Days outside the date dimension drop out (inner join), as in the report.
    """
    dd = lookup(dim_date.select(F.col("date_id").alias("logged_date_id"), "week_of_year", "month_name"))
    d = (daily_totals(fct_mln, daily).join(_names(dim_nutrients), "nutrient_id")
         .join(dd, "logged_date_id", "inner").withColumnRenamed("daily_value_g", "dv"))
    out = d.select(
        "user_id", "nutrient_name", "logged_date", "week_of_year", "month_name",
        as_double(d, "dv").alias("daily_value_g"),
        rolling_average("dv", ["user_id", "nutrient_id"], "logged_date", exact=G.is_grams(d, "dv")).alias("rolling_7d_avg_g"))
    return _sorted(out, ordered, "user_id", "nutrient_name", "logged_date")


def latest_day(fct: DataFrame, date_col: str = "logged_date") -> Column:
    """Scalar subquery: the latest date in the table (global)."""
    return fct.select(F.max(date_col)).scalar()


def latest_segments_report(fct_segments: DataFrame, dim_nutrients: DataFrame, ordered: bool = True) -> DataFrame:
    """Every user's status on the globally latest logged day."""
    s = fct_segments.where(F.col("logged_date") == latest_day(fct_segments))
    out = s.join(lookup(dim_nutrients.select("nutrient_id", "nutrient_name")), "nutrient_id").select(
        "user_id", "nutrient_name", "logged_date", "daily_value_g", "threshold_g", "threshold_type",
        "segment_label", "is_flagged")
    return _sorted(out, ordered, "user_id", "nutrient_name")


def windowed_report(fct_windowed: DataFrame, dim_nutrients: DataFrame, ordered: bool = True) -> DataFrame:
    """Last day / 7-day / 30-day snapshot with nutrient names."""
    out = fct_windowed.join(lookup(dim_nutrients.select("nutrient_id", "nutrient_name")), "nutrient_id").select(
        "user_id", "nutrient_name", "segment_label", "threshold_g", "threshold_type", "last_day_g",
        "last_7d_avg_g", "last_30d_avg_g", "is_flagged_last_day", "is_flagged_last_7d", "is_flagged_last_30d")
    return _sorted(out, ordered, "user_id", "nutrient_name")


SEGMENT_LABELS = ["low_protein", "high_fat", "low_fiber", "high_sugar"]


def segment_pivot_report(fct_segments: DataFrame, labels: list[str] | None = None,
                         ordered: bool = True) -> DataFrame:
    """One row per user, one boolean per segment, on the latest day.

    A NULL flag counts as not flagged.
    """
    labels = labels or SEGMENT_LABELS
    s = fct_segments.where(F.col("logged_date") == latest_day(fct_segments))
    hit = lambda lb: F.when((F.col("segment_label") == lb) & F.col("is_flagged"), True).otherwise(False)
    out = s.groupBy("user_id").agg(*[F.max(hit(lb)).alias(lb) for lb in labels])
    return _sorted(out, ordered, "user_id")


def food_log_join(fct_meal_logs: DataFrame, dim_foods: DataFrame, dim_meals: DataFrame) -> DataFrame:
    f = dim_foods.select("fdc_id", F.col("description").alias("food_name"))
    return (fct_meal_logs.join(f, "fdc_id", "inner")
            .join(lookup(dim_meals.select("meal_id", "meal_name")), "meal_id", "inner"))


def daily_food_log_report(fct_meal_logs: DataFrame, dim_foods: DataFrame, dim_meals: DataFrame,
                          report_date: Column | str | None = None, ordered: bool = True) -> DataFrame:
    """The items each user logged on one day (default: the latest day)."""
    day = latest_day(fct_meal_logs) if report_date is None else (
        F.lit(report_date).cast("date") if isinstance(report_date, str) else report_date)
    out = food_log_join(fct_meal_logs.where(F.col("logged_date") == day), dim_foods, dim_meals).select(
        "user_id", "logged_date", "meal_name", "food_name", "grams")
    return _sorted(out, ordered, "user_id", "meal_name", "food_name")


def weekly_food_log_report(fct_meal_logs: DataFrame, dim_foods: DataFrame, dim_meals: DataFrame,
                           ordered: bool = True) -> DataFrame:
    """Per user, week, meal and food: times logged and average serving."""
    j = food_log_join(fct_meal_logs, dim_foods, dim_meals).withColumn("serving", G.amount("grams"))
    out = j.groupBy("user_id", week_start("logged_date").alias("week_start"), "meal_name", "food_name").agg(
        F.count(F.lit(1)).alias("times_logged"),
        round_half_away(F.try_divide(G.to_double(G.total("serving")), F.count("grams").cast("double")), 1).alias("avg_grams"))
    return _sorted(out, ordered, "user_id", "week_start", "meal_name", F.col("times_logged").desc())


def bmi_evolution_report(fct_bmi: DataFrame, dim_date: DataFrame, ordered: bool = True) -> DataFrame:
    """BMI at each weigh-in, with its calendar date."""
    dd = lookup(dim_date.select(F.col("date_id").alias("recorded_date_id"), F.col("full_date").alias("recorded_date")))
    out = fct_bmi.join(dd, "recorded_date_id", "inner").select(
        "user_id", "recorded_date", "weight_kg", "height_cm", "bmi")
    return _sorted(out, ordered, "user_id", "recorded_date")
