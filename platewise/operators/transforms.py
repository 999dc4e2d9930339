"""Intermediate operators C1-C8.

Shape of the plans (checked with ``explain``):

* C1 reads each food's nutrient list with higher-order array functions (no
  explode) and then merges documents of one food and load by a map-side
  combined ``max`` per nutrient.
* C2 is a single ``inline`` over the three meal arrays (one Generate, one
  scan) instead of three unnests unioned together.
* C4 sums the five nutrient columns per user-day first (partial aggregation
  before the exchange), then unpivots the aggregate: 5x fewer rows shuffled.
  C7 and C8 work on those wide rows up to their last step: the user join, the
  anchor window and the trailing averages see one row per user-day.
* C5 picks the latest weight with ``max_by`` (a partial aggregate, safe for a
  user with a huge number of weigh-ins) and joins the BMI bands by an
  equi-join on bins (``bands.band_join``), however many there are.
* C8 gets each user's anchor date from a window over the already aggregated
  daily rows (at most 31 days per user), avoiding a self-join.

Joins against the user and food dimensions are left to the planner: they are
broadcast when statistics (or AQE at run time) show they fit the broadcast
threshold, else sort-merge with AQE skew splitting.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .. import schemas
from ..functions import AMOUNT_TYPE, avg_round2, date_id, round_exact, round_half_away, threshold_flag
from ..functions import grams as G
from ..sources import seeds
from .bands import band_join

NUTRIENTS = seeds.NUTRIENT_VALUE_COLUMNS


# ------------------------------------------------------------------------ C1
def _nutrient_amount(items: Column, number: str) -> Column:
    """max over the list of the amounts tagged ``number``; text amounts -> NULL."""
    picked = F.filter(items, lambda x: x["number"] == F.lit(number))
    return F.array_max(F.transform(picked, lambda x: x["amount"].try_cast(AMOUNT_TYPE)))


def food_nutrients(stg_foods: DataFrame, latest_only: bool = False) -> DataFrame:
    """One row per food (and load) with the five macro nutrients per 100 g.

    Foods whose nutrient list is empty or missing disappear (inner lateral
    semantics); a nutrient number that occurs several times, in one document
    or in several of one food and load, keeps its max; unparsable amounts
    count as 0. ``latest_only`` keeps only the newest load of each fdc_id
    (§2.10 item 5).

    Uses the parsed ``food_nutrients`` column of B1 where it is there, else
    parses ``raw_json``.
    """
    items = F.col("food_nutrients") if "food_nutrients" in stg_foods.columns else F.from_json(
        "raw_json", f"struct<foodNutrients:{schemas.FOOD_NUTRIENTS_JSON}>")["foodNutrients"]
    keys = ["fdc_id", "description", "publication_date", "loaded_at"]
    with_items = stg_foods.select(*keys, items.alias("_n")).where(F.size("_n") > 0)
    per_document = with_items.select(*keys, *[_nutrient_amount(F.col("_n"), num).alias(name)
                                              for num, name in seeds.NUTRIENT_COLUMNS])
    merged = per_document.groupBy(*keys).agg(*[
        F.coalesce(F.max(name), F.lit(0).cast(AMOUNT_TYPE)).alias(name) for _, name in seeds.NUTRIENT_COLUMNS])
    if latest_only:
        merged = latest_load(merged)
    return merged.select(
        "fdc_id",
        "description",
        date_id("publication_date").alias("publication_date_id"),
        date_id(F.to_date("loaded_at")).alias("loaded_date_id"),
        *NUTRIENTS,
    )


def latest_load(foods: DataFrame) -> DataFrame:
    """Keep the newest ``loaded_at`` row per fdc_id (partial aggregate, skew safe)."""
    cols = [c for c in foods.columns if c != "fdc_id"]
    order = F.struct("loaded_at", *[c for c in cols if c != "loaded_at"])  # deterministic ties
    latest = foods.groupBy("fdc_id").agg(F.max_by(F.struct(*cols), order).alias("_r"))
    return latest.select("fdc_id", *[F.col("_r")[c].alias(c) for c in cols])


# ------------------------------------------------------------------------ C2
def meal_items(stg_meal_logs: DataFrame, meals: DataFrame | None = None) -> DataFrame:
    """One row per logged item (user, meal, food, grams, day).

    The three arrays are tagged with their meal name and inlined in one pass;
    the meal seed resolves the name to meal_id. Items without a food id or
    grams are dropped.
    """
    spark = stg_meal_logs.sparkSession
    meals = meals if meals is not None else seeds.meals(spark)

    def tagged(name: str) -> Column:
        return F.transform(F.col(name), lambda x: F.struct(
            F.lit(name).alias("meal_name"), x["fdc_id"].alias("fdc_id"), x["grams"].alias("grams")))

    flat = stg_meal_logs.select(
        "user_id", "logged_at",
        F.inline(F.concat(tagged("breakfast"), tagged("lunch"), tagged("dinner"))),
    ).where(F.col("fdc_id").isNotNull() & F.col("grams").isNotNull())
    d = F.to_date("logged_at")
    return flat.join(seeds.lookup(meals), "meal_name", "inner").select(
        "user_id", "meal_id", "fdc_id", "grams",
        d.alias("logged_date"), date_id(d).alias("logged_date_id"),
    )


# ------------------------------------------------------------------------ C3
def scaled_nutrients(items: DataFrame, foods: DataFrame) -> DataFrame:
    """C3 with DECIMAL(38,18) columns: ``scaled_exact`` for SQL users, files and streams."""
    return G.as_decimals(scaled_exact(items, foods))


def scaled_exact(items: DataFrame, foods: DataFrame) -> DataFrame:
    """Item ⋈ food, each nutrient scaled by grams/100, as exact gram amounts (``functions.grams``).

    Unknown foods drop the item (inner join). The per-gram factors are
    computed once per food (the small side of the join). Any double is a valid
    serving: whole grams, and servings of up to six decimals of foods given to
    four, are one multiplication of long integers; others are exact decimals
    (twelve decimals of a serving count), and what no decimal holds is a double.
    """
    i = items.select("user_id", "meal_id", "fdc_id", "grams", "logged_date", "logged_date_id")
    scaled = G.servings(i.join(G.factors(foods, "fdc_id", NUTRIENTS), "fdc_id", "inner"), "grams", NUTRIENTS)
    return scaled.select("user_id", "meal_id", "logged_date", "logged_date_id", *NUTRIENTS)


# ------------------------------------------------------------------------ C4
DAY_KEYS = ["user_id", "logged_date", "logged_date_id"]


def to_long(df: DataFrame, keys: list[str], value_name: str) -> DataFrame:
    """Wide five-nutrient row -> five (nutrient_id, value) rows, in one Generate."""
    pairs = [F.struct(F.lit(i + 1).alias("nutrient_id"), F.col(n).alias(value_name))
             for i, n in enumerate(NUTRIENTS)]
    return df.select(*keys, F.inline(F.array(*pairs)))


def to_wide(long: DataFrame, value: str) -> DataFrame:
    """(user, nutrient, day, value) rows -> one row per user-day with five exact sums (one map-side combined pass)."""
    return long.groupBy(*DAY_KEYS).agg(*[
        F.sum(F.when(F.col("nutrient_id") == i + 1, F.col(value))).alias(n) for i, n in enumerate(NUTRIENTS)])


def since_days(df: DataFrame, as_of: Column | str, days: int, column: str = "logged_date") -> DataFrame:
    """Rows from ``days`` before ``as_of`` on; ``as_of`` is a date literal or a Column (e.g. a scalar subquery)."""
    as_of_col = F.lit(as_of).cast("date") if isinstance(as_of, str) else as_of
    return df.where(F.col(column) >= F.date_sub(as_of_col, days))


def grouped_grams(scaled: DataFrame, keys: list[str]) -> DataFrame:
    """Per-group exact grams of the five nutrients (wide), in the form of ``scaled``; map-side combined."""
    if G.is_grams(scaled, NUTRIENTS[0]):
        return G.totals(scaled, keys, NUTRIENTS).select(*keys, *[F.get("_totals", F.lit(k)).alias(n) for k, n in enumerate(NUTRIENTS)])
    return scaled.groupBy(*keys).agg(*[F.sum(n).alias(n) for n in NUTRIENTS])


def daily_wide(scaled: DataFrame, as_of: Column | str, history_days: int = 365) -> DataFrame:
    """One row per user-day with the five exact sums, over the trailing window."""
    return grouped_grams(since_days(scaled, as_of, history_days), DAY_KEYS)


def daily_intake(scaled: DataFrame, as_of: Column | str, history_days: int = 365) -> DataFrame:
    """C4: per user, nutrient and day: total grams, over the trailing window.

    ``as_of`` replaces the warehouse's ``current_date``.
    """
    return daily_long(daily_wide(scaled, as_of, history_days))


def daily_long(wide: DataFrame) -> DataFrame:
    return to_long(wide, DAY_KEYS, "daily_value_g").select(
        "user_id", "nutrient_id", "logged_date", "logged_date_id", "daily_value_g")


def daily_totals(scaled: DataFrame) -> DataFrame:
    """Exact daily grams per user and nutrient, straight from scaled items.

    Five sums per user-day are aggregated (map-side combined) before one
    Generate emits the nutrient rows. Equal to summing the per-meal fact over
    meals, with one shuffle less.
    """
    return daily_long(grouped_grams(scaled, DAY_KEYS))


def totals_wide(scaled: DataFrame) -> DataFrame:
    """``daily_totals`` without its last step: one row per user and day (no date id) with the five sums, over all days."""
    return grouped_grams(scaled, ["user_id", "logged_date"])


# ------------------------------------------------------------------------ C5
def latest_weight(stg_weights: DataFrame) -> DataFrame:
    """Most recent weigh-in per user; ties on recorded_at broken by weight_log_id."""
    return stg_weights.groupBy("user_id").agg(
        F.max_by("weight_kg", F.struct("recorded_at", "weight_log_id")).alias("weight_kg"))


def users_with_bmi(stg_users: DataFrame, stg_weights: DataFrame,
                   bmi_categories: DataFrame | None = None) -> DataFrame:
    """User profile with latest weight, BMI and BMI band (half-open).

    Users without a weight, or whose BMI falls in no band, are dropped.
    """
    from ..functions import bmi
    spark = stg_users.sparkSession
    cats = bmi_categories if bmi_categories is not None else seeds.bmi_categories(spark)
    calc = stg_users.join(latest_weight(stg_weights), "user_id", "inner").select(
        "user_id", "country", "birth_date", "weight_kg", "height_cm",
        bmi("weight_kg", "height_cm").alias("bmi"),
        date_id(F.to_date("registered_at")).alias("registered_date_id"),
    )
    bands = cats.select("min_bmi", "max_bmi", F.col("category").alias("bmi_category"))
    return band_join(calc, "bmi", bands, "min_bmi", "max_bmi").select(
        "user_id", "country", "birth_date", "weight_kg", "height_cm", "bmi",
        "registered_date_id", "bmi_category")


# ------------------------------------------------------------------------ C6
def bmi_history(stg_weights: DataFrame, stg_users: DataFrame) -> DataFrame:
    """BMI at every weigh-in."""
    from ..functions import bmi
    u = stg_users.select("user_id", "height_cm")
    return stg_weights.join(u, "user_id", "inner").select(
        "weight_log_id", "user_id", "weight_kg", "height_cm",
        bmi("weight_kg", "height_cm").alias("bmi"),
        date_id(F.to_date("recorded_at")).alias("recorded_date_id"),
    )


# ------------------------------------------------------------------- C7 / C8
def segment_targets(targets: DataFrame) -> DataFrame:
    """Targets that define a segment (carbohydrate has none)."""
    return seeds.lookup(targets.where(F.col("segment_label").isNotNull()).select(
        "nutrient_id", "recommended_daily_g", "threshold_type", "segment_label"))


def threshold_column(personal: dict[int, float]) -> Column:
    """Personal threshold (round(weight * g_per_kg, 1)) or the generic target."""
    expr = None
    for nid, per_kg in sorted(personal.items()):
        v = round_half_away(F.col("weight_kg") * F.lit(float(per_kg)), 1)
        expr = F.when(F.col("nutrient_id") == nid, v) if expr is None else expr.when(
            F.col("nutrient_id") == nid, v)
    generic = F.col("recommended_daily_g").cast("double")
    return generic if expr is None else expr.otherwise(generic)


def nutrient_segments(daily: DataFrame, users_bmi: DataFrame, targets: DataFrame | None = None,
                      personal_targets: dict[int, float] | None = None) -> DataFrame:
    """Per user, nutrient and day, flag intake outside the target.

    ``daily`` has one wide row per user-day (``daily_wide``, ``to_wide``). The
    value is rounded to 2 decimals *before* the comparison.
    """
    spark = daily.sparkSession
    tg = segment_targets(targets if targets is not None else seeds.nutrient_daily_targets(spark))
    personal = seeds.PERSONAL_TARGETS if personal_targets is None else personal_targets
    known = daily.join(users_bmi.select("user_id", "weight_kg"), "user_id", "inner")
    exact = G.is_grams(daily, NUTRIENTS[0])
    there = G.known("daily_value_g") if exact else F.col("daily_value_g").isNotNull()
    j = to_long(known, [*DAY_KEYS, "weight_kg"], "daily_value_g").where(there).join(tg, "nutrient_id", "inner")
    value = G.round2("daily_value_g") if exact else round_exact(F.col("daily_value_g"), 2).cast("double")
    out = j.select(
        "user_id", "nutrient_id", "logged_date", "logged_date_id",
        value.alias("daily_value_g"),
        threshold_column(personal).alias("threshold_g"),
        "threshold_type", "segment_label",
    )
    return out.withColumn("is_flagged", threshold_flag("threshold_type", F.col("daily_value_g"),
                                                       F.col("threshold_g")))


def segments_windowed(daily: DataFrame, users_bmi: DataFrame, as_of: Column | str,
                      targets: DataFrame | None = None, personal_targets: dict[int, float] | None = None,
                      prefilter_days: int = 30, short_days: int = 7, long_days: int = 30) -> DataFrame:
    """Per user and nutrient, last-day / 7-day / 30-day intake vs target.

    ``daily`` has one wide row per user-day. Windows are anchored at each
    user's last logged day inside the prefilter (``as_of - prefilter_days``);
    averages skip unlogged days.
    """
    spark = daily.sparkSession
    tg = segment_targets(targets if targets is not None else seeds.nutrient_daily_targets(spark))
    personal = seeds.PERSONAL_TARGETS if personal_targets is None else personal_targets
    recent = since_days(daily, as_of, prefilter_days).select(
        "user_id", "logged_date", *NUTRIENTS,
        F.max("logged_date").over(Window.partitionBy("user_id")).alias("reference_date"))
    d, ref = F.col("logged_date"), F.col("reference_date")
    frames = {"_1": d == ref, "_s": d >= F.date_sub(ref, short_days - 1), "_l": d >= F.date_sub(ref, long_days - 1)}
    exact = G.is_grams(daily, NUTRIENTS[0])
    if exact:  # each frame's amounts as columns of their own, to be added by name
        recent = recent.select("user_id", "reference_date", *[F.when(inside, F.col(n)).alias(n + f)
                                                              for n in NUTRIENTS for f, inside in frames.items()])

    def measures(n: str) -> Column:
        one, short, long = (F.when(inside, F.col(n)) for inside in frames.values())
        return F.struct(F.max(one).cast("double").alias("last_day_g"), avg_round2(short).alias("last_7d_avg_g"),
                        avg_round2(long).alias("last_30d_avg_g")).alias(n)

    keys = ["user_id", "reference_date"]
    if exact:
        sums = G.totals(recent, keys, [n + f for n in NUTRIENTS for f in frames],
                        *[F.count_if(G.known(n + f)).alias(f"n{n}{f}") for n in NUTRIENTS for f in frames])
        grams = sums.select("*", F.transform("_totals", G.to_double).alias("_g"))
        at = lambda k, f: F.get("_g", F.lit(3 * k + list(frames).index(f)))
        mean = lambda k, n, f: round_half_away(F.try_divide(at(k, f), F.col(f"n{n}{f}").cast("double")), 2)
        windowed = grams.select(*keys, *[F.struct(at(k, "_1").alias("last_day_g"), mean(k, n, "_s").alias("last_7d_avg_g"),
                                                  mean(k, n, "_l").alias("last_30d_avg_g")).alias(n) for k, n in enumerate(NUTRIENTS)])
    else:
        windowed = recent.groupBy(*keys).agg(*[measures(n) for n in NUTRIENTS])
    known = windowed.join(users_bmi.select("user_id", "weight_kg"), "user_id", "inner")
    # a nutrient without any value in the user's window has no row (as in the long form)
    long = to_long(known, ["user_id", "reference_date", "weight_kg"], "m").where(F.col("m.last_30d_avg_g").isNotNull())
    j = long.join(tg, "nutrient_id", "inner").select(
        "user_id", "nutrient_id", "reference_date", "m.last_day_g", "m.last_7d_avg_g", "m.last_30d_avg_g",
        threshold_column(personal).alias("threshold_g"), "threshold_type", "segment_label")
    t = F.col("threshold_g")
    return j.select(
        "*",
        threshold_flag("threshold_type", F.col("last_day_g"), t).alias("is_flagged_last_day"),
        threshold_flag("threshold_type", F.col("last_7d_avg_g"), t).alias("is_flagged_last_7d"),
        threshold_flag("threshold_type", F.col("last_30d_avg_g"), t).alias("is_flagged_last_30d"),
    )
