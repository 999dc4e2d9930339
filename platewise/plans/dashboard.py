"""Dashboard queries D1-D13, for all users at once.

The dashboard ran each query for one user with values pasted into SQL
text. Here every query is a function over the marts with typed arguments:
``users`` (optional list of ids, a Column predicate, never string-built SQL)
and an inclusive date range ``start``..``end`` (date strings or Columns such
as scalar subqueries). Filters are applied before windows, so a range that
starts mid-history gives partial rolling frames exactly like the page did.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import grams as G
from ..functions import month_label, month_start, round_half_away, week_label, week_start
from ..sources.seeds import lookup
from .reports import as_double, food_log_join, mean2, rolling_average

DateArg = Column | str | None


def _d(v: DateArg) -> Column | None:
    if v is None:
        return None
    return F.lit(v).cast("date") if isinstance(v, str) else v


def _filter(df: DataFrame, users: list[int] | None, date_col: str, start: DateArg, end: DateArg,
            user_col: str = "user_id") -> DataFrame:
    if users is not None:
        df = df.where(F.col(user_col).isin(list(users)))
    s, e = _d(start), _d(end)
    if s is not None:
        df = df.where(F.col(date_col) >= s)
    if e is not None:
        df = df.where(F.col(date_col) <= e)
    return df


def max_logged_date(fct_meal_logs: DataFrame) -> DataFrame:
    """The latest logged day (upper bound of the date filter)."""
    return fct_meal_logs.agg(F.max("logged_date").alias("max_date"))


def user_list(dim_users: DataFrame) -> DataFrame:
    """User ids in order."""
    return dim_users.select("user_id").orderBy("user_id")


def user_overview(dim_users: DataFrame, dim_date: DataFrame, users: list[int] | None = None) -> DataFrame:
    """D3: profile card with the registration date resolved through dim_date."""
    dd = dim_date.select(F.col("date_id").alias("registered_date_id"), F.col("full_date").alias("registered_date"))
    u = _filter(dim_users, users, "user_id", None, None)
    return u.join(dd, "registered_date_id", "inner").select(
        "user_id", "country", "birth_date", "weight_kg", "height_cm", "bmi", "bmi_category",
        "recommended_protein_g", "registered_date")


def _daily_named(fct_mln: DataFrame | None, dim_nutrients: DataFrame, users, start, end,
                 daily: DataFrame | None = None) -> DataFrame:
    """Daily totals in the range with nutrient names; filters run first (on the
    fact, or on precomputed daily totals: the date is a grouping key)."""
    if daily is None:
        f = _filter(fct_mln, users, "logged_date", start, end)
        daily = f.groupBy("user_id", "nutrient_id", "logged_date").agg(F.sum("value_g").alias("daily_value_g"))
    else:
        daily = _filter(daily, users, "logged_date", start, end)
    return daily.join(lookup(dim_nutrients.select("nutrient_id", "nutrient_name")), "nutrient_id").select(
        "user_id", "nutrient_id", "nutrient_name", "logged_date", F.col("daily_value_g").alias("dv"))


def nutrient_rolling(fct_mln: DataFrame | None, dim_nutrients: DataFrame, users=None, start: DateArg = None,
                     end: DateArg = None, daily: DataFrame | None = None) -> DataFrame:
    """Daily intake and 7-row rolling average inside the date range."""
    d = _daily_named(fct_mln, dim_nutrients, users, start, end, daily)
    return d.select("user_id", "nutrient_name", "logged_date", as_double(d, "dv").alias("daily_value_g"),
                    rolling_average("dv", ["user_id", "nutrient_id"], "logged_date", exact=G.is_grams(d, "dv")).alias("rolling_7d_avg_g")
                    ).orderBy("user_id", "nutrient_name", "logged_date")


def weekly_user(fct_mln: DataFrame | None, dim_nutrients: DataFrame, users=None, start: DateArg = None,
                end: DateArg = None, daily: DataFrame | None = None) -> DataFrame:
    """Weekly average daily intake inside the range."""
    d = _daily_named(fct_mln, dim_nutrients, users, start, end, daily)
    return d.groupBy("user_id", "nutrient_id", "nutrient_name", week_start("logged_date").alias("week_start")).agg(
        mean2(d, "dv").alias("weekly_avg_g")).select(
        "user_id", "nutrient_name", "week_start", "weekly_avg_g").orderBy("user_id", "nutrient_name", "week_start")


def monthly_user(fct_mln: DataFrame | None, dim_nutrients: DataFrame, users=None, start: DateArg = None,
                 end: DateArg = None, daily: DataFrame | None = None) -> DataFrame:
    """Monthly average and month-over-month delta inside the range."""
    d = _daily_named(fct_mln, dim_nutrients, users, start, end, daily)
    m = d.groupBy("user_id", "nutrient_id", "nutrient_name", month_start("logged_date").alias("month_start")).agg(
        mean2(d, "dv").alias("monthly_avg_g"))
    prev = F.lag("monthly_avg_g").over(Window.partitionBy("user_id", "nutrient_id").orderBy("month_start"))
    return m.select("user_id", "nutrient_name", "month_start", "monthly_avg_g",
                    round_half_away(F.col("monthly_avg_g") - prev, 2).alias("mom_delta_g")
                    ).orderBy("user_id", "nutrient_name", "month_start")


def food_log_range(fct_meal_logs: DataFrame, dim_foods: DataFrame, dim_meals: DataFrame, users=None,
                   start: DateArg = None, end: DateArg = None) -> DataFrame:
    """Items logged in the range, newest day first."""
    f = _filter(fct_meal_logs, users, "logged_date", start, end)
    return food_log_join(f, dim_foods, dim_meals).select(
        "user_id", "logged_date", "meal_name", F.col("food_name").alias("description"), "grams"
    ).orderBy("user_id", F.col("logged_date").desc(), "meal_name")


def bmi_range(fct_bmi: DataFrame, dim_date: DataFrame, users=None, start: DateArg = None,
              end: DateArg = None) -> DataFrame:
    """Weigh-ins inside the range (filter on the calendar date)."""
    dd = lookup(dim_date.select(F.col("date_id").alias("recorded_date_id"), F.col("full_date").alias("recorded_date")))
    j = _filter(fct_bmi.join(dd, "recorded_date_id", "inner"), users, "recorded_date", start, end)
    return j.select("user_id", "recorded_date", "weight_kg", "bmi").orderBy("user_id", "recorded_date")


def windowed_user(fct_windowed: DataFrame, dim_nutrients: DataFrame, users=None) -> DataFrame:
    """The windowed snapshot table for the selected users."""
    w = _filter(fct_windowed, users, "reference_date", None, None)
    return w.join(lookup(dim_nutrients.select("nutrient_id", "nutrient_name")), "nutrient_id").select(
        "user_id", "nutrient_name", "last_day_g", "last_7d_avg_g", "last_30d_avg_g", "threshold_g",
        "segment_label", "is_flagged_last_day", "is_flagged_last_7d", "is_flagged_last_30d"
    ).orderBy("user_id", "nutrient_name")


def flagged_counts(fct_segments: DataFrame, dim_nutrients: DataFrame, start: DateArg = None,
                   end: DateArg = None) -> DataFrame:
    """Per nutrient and day, users classified and users flagged (NULL = not flagged)."""
    s = _filter(fct_segments, None, "logged_date", start, end)
    j = s.join(lookup(dim_nutrients.select("nutrient_id", "nutrient_name")), "nutrient_id")
    return j.groupBy("nutrient_id", "nutrient_name", "logged_date").agg(
        F.count(F.lit(1)).alias("total_users"),
        F.count_if(F.coalesce(F.col("is_flagged"), F.lit(False))).alias("flagged_users"),
    ).select("nutrient_name", "logged_date", "total_users", "flagged_users").orderBy("nutrient_name", "logged_date")


def first_last_delta(fct_bmi: DataFrame, dim_date: DataFrame, users=None, start: DateArg = None,
                     end: DateArg = None) -> DataFrame:
    """Latest value and change since the first weigh-in in range, per user.

    Computed with max_by/min_by (partial aggregates) instead of pulling the
    series to the driver; same-day ties are broken by weight_log_id.
    """
    dd = lookup(dim_date.select(F.col("date_id").alias("recorded_date_id"), F.col("full_date").alias("recorded_date")))
    j = _filter(fct_bmi.join(dd, "recorded_date_id", "inner"), users, "recorded_date", start, end)
    k = F.struct("recorded_date", "weight_log_id")
    g = j.groupBy("user_id").agg(
        F.max_by("weight_kg", k).alias("current_weight_kg"), F.min_by("weight_kg", k).alias("first_weight_kg"),
        F.max_by("bmi", k).alias("current_bmi"), F.min_by("bmi", k).alias("first_bmi"))
    return g.select("user_id", "current_weight_kg",
                    round_half_away(F.col("current_weight_kg") - F.col("first_weight_kg"), 1).alias("weight_delta_kg"),
                    "current_bmi",
                    round_half_away(F.col("current_bmi") - F.col("first_bmi"), 1).alias("bmi_delta"))


def with_week_label(weekly: DataFrame) -> DataFrame:
    """D12: '%Y-W%W' label for a weekly series."""
    return weekly.withColumn("week_label", week_label("week_start"))


def with_month_label(monthly: DataFrame) -> DataFrame:
    """D12: '%b %Y' label for a monthly series."""
    return monthly.withColumn("month_label", month_label("month_start"))


def day_meals(fct_meal_logs: DataFrame, dim_foods: DataFrame, dim_meals: DataFrame, users=None,
              start: DateArg = None, end: DateArg = None) -> DataFrame:
    """What was eaten, per user, day and meal: one row per item, newest day first.

    The page shows one day's rows in three lists; choosing the day and laying
    the meals side by side is left to the caller, so that a busy user-day is
    never gathered into one row."""
    f = _filter(fct_meal_logs, users, "logged_date", start, end)
    return food_log_join(f, dim_foods, dim_meals).select(
        "user_id", "logged_date", "meal_name", F.col("food_name").alias("description"), "grams"
    ).orderBy("user_id", F.col("logged_date").desc(), "meal_name", "description")


def date_labels(daily: DataFrame, start: DateArg = None, end: DateArg = None) -> DataFrame:
    """Every logged day in the range with its week/month starts and chart labels."""
    d = _filter(daily, None, "logged_date", start, end).select("logged_date").distinct()
    return d.select("logged_date", week_start("logged_date").alias("week_start"),
                    week_label("logged_date").alias("week_label"),
                    month_start("logged_date").alias("month_start"),
                    month_label("logged_date").alias("month_label")).orderBy("logged_date")

