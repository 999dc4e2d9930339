"""Registered queries: one per operator of the inventory, over the driver's tables.

Every query reads the parquet tables under ``sf_dir`` (or frames Spark
derives from them) and runs over them whole. Keys follow SURVEY §7.3.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import dashboard as D
from . import reports as R
from ..functions import grams as G
from ..functions import instant_to_utc
from ..functions import windows as FW
from ..operators import marts as M
from ..operators.bands import band_extremes
from ..operators import quality as Q
from ..operators import staging as S
from ..operators import transforms as T
from ..operators import versions as V
from ..operators import writes as W
from ..session import scratch_dir
from ..sources import fixtures, seeds
from .build import Warehouse

QueryFn = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, QueryFn] = {}


def query(key: str) -> Callable[[QueryFn], QueryFn]:
    def deco(fn: QueryFn) -> QueryFn:
        QUERIES[key] = fn
        return fn
    return deco


def events_wh(spark: SparkSession, sf: str, **kw) -> Warehouse:
    return Warehouse.from_testdata(spark, sf, "events", **kw)


def orders_wh(spark: SparkSession, sf: str, **kw) -> Warehouse:
    return Warehouse.from_testdata(spark, sf, "orders", **kw)


# ----------------------------------------------------------------- staging
@query("b1_stg_foods")
def b1_stg_foods(spark, sf):
    return events_wh(spark, sf).stg_foods.select("fdc_id", "description", "publication_date", "loaded_at")


@query("b2_stg_users")
def b2_stg_users(spark, sf):
    return events_wh(spark, sf).stg_users


@query("b3_stg_weights")
def b3_stg_weights(spark, sf):
    return events_wh(spark, sf).stg_weights


# ------------------------------------------------------------ intermediate
@query("c1_food_pivot")
def c1_food_pivot(spark, sf):
    return M.as_double(events_wh(spark, sf).food_nutrients)


@query("c2_meal_unpivot")
def c2_meal_unpivot(spark, sf):
    return events_wh(spark, sf).items


@query("c3_scaled")
def c3_scaled(spark, sf):
    return M.as_double(orders_wh(spark, sf).scaled_exact)


@query("g1_exact_sums")
def g1_exact_sums(spark, sf):
    """G1: each user's grams over all days, to twelve decimals, of long, tiny and huge servings."""
    w = orders_wh(spark, sf, items_override=fixtures.items_odd_servings(spark, sf))
    sums = T.grouped_grams(w.scaled_exact, ["user_id"])
    return sums.select("user_id", *[G.to_decimal(n).cast("decimal(38,12)").cast("string").alias(n) for n in T.NUTRIENTS])


@query("c4_daily_intake")
def c4_daily_intake(spark, sf):
    return M.as_double(orders_wh(spark, sf).daily_exact)


@query("c5_user_bmi")
def c5_user_bmi(spark, sf):
    return events_wh(spark, sf).users_bmi


@query("j3_weight_bands")
def j3_weight_bands(spark, sf):
    """Weigh-ins in bands of many widths (one per part; gaps, overlaps, empty and open ones): number and extremes."""
    w = events_wh(spark, sf)
    met = band_extremes(w.stg_weights.select("weight_kg"), "weight_kg", fixtures.weight_bands(spark, sf), "band_id", "low_kg", "high_kg")
    return met.select("band_id", F.col("n").alias("weigh_ins"), F.col("least").alias("min_kg"), F.col("most").alias("max_kg"))


@query("c6_bmi_history")
def c6_bmi_history(spark, sf):
    return events_wh(spark, sf).bmi_history


@query("c7_segments")
def c7_segments(spark, sf):
    return events_wh(spark, sf).fct_user_segments


@query("c8_windowed")
def c8_windowed(spark, sf):
    return events_wh(spark, sf).fct_user_segments_windowed


# ------------------------------------------------------------------- marts
@query("m2_dim_users")
def m2_dim_users(spark, sf):
    return events_wh(spark, sf).dim_users


@query("m5_dim_foods")
def m5_dim_foods(spark, sf):
    return M.as_double(events_wh(spark, sf).dim_foods)


@query("m7_meal_nutrients")
def m7_meal_nutrients(spark, sf):
    return M.as_double(orders_wh(spark, sf).meal_nutrients_exact)


# ----------------------------------------------------------- more staging
@query("b4_stg_meal_logs")
def b4_stg_meal_logs(spark, sf):
    """Staged nested logs, flattened to per-meal item counts for comparison."""
    s = events_wh(spark, sf).stg_meal_logs
    return s.select("user_id", "logged_at", F.size("breakfast").alias("n_breakfast"),
                    F.size("lunch").alias("n_lunch"), F.size("dinner").alias("n_dinner"))


@query("m1_dim_date")
def m1_dim_date(spark, sf):
    """Date dimension spanning the long item history (bounds are scalar subqueries)."""
    lo, hi = orders_wh(spark, sf).feed_span()
    return M.dim_date(spark, lo, hi, end_inclusive=True)


# ----------------------------------------------------------------- reports


def _range(w: Warehouse):
    """Dashboard date range: from a week after the feed's first day to its last day."""
    lo, hi = w.feed_span()
    return F.date_add(lo, 7), hi


@query("r1_daily")
def r1_daily(spark, sf):
    w = orders_wh(spark, sf)
    return R.daily_intake_report(None, w.dim_nutrients, daily=w.daily_totals)


@query("r2_weekly")
def r2_weekly(spark, sf):
    w = orders_wh(spark, sf)
    return R.weekly_average_report(None, w.dim_nutrients, daily=w.daily_totals)


@query("r3_mom")
def r3_mom(spark, sf):
    w = orders_wh(spark, sf)
    return R.monthly_mom_report(None, w.dim_nutrients, wide=w.totals_wide)


@query("r4_rolling")
def r4_rolling(spark, sf):
    w = events_wh(spark, sf)
    return R.rolling_report(None, w.dim_nutrients, w.dim_date, daily=w.daily_totals)


@query("r5_latest")
def r5_latest(spark, sf):
    w = events_wh(spark, sf)
    return R.latest_segments_report(w.fct_user_segments, w.dim_nutrients)


@query("r6_windowed_report")
def r6_windowed_report(spark, sf):
    w = events_wh(spark, sf)
    return R.windowed_report(w.fct_user_segments_windowed, w.dim_nutrients)


@query("r7_segment_pivot")
def r7_segment_pivot(spark, sf):
    return R.segment_pivot_report(events_wh(spark, sf).fct_user_segments)


@query("r8_food_log")
def r8_food_log(spark, sf):
    w = events_wh(spark, sf)
    return R.daily_food_log_report(w.fct_meal_logs, w.dim_foods, w.dim_meals, report_date=w.as_of)


@query("r9_weekly_food")
def r9_weekly_food(spark, sf):
    w = orders_wh(spark, sf)
    return R.weekly_food_log_report(w.fct_meal_logs, w.dim_foods, w.dim_meals)


@query("r10_bmi")
def r10_bmi(spark, sf):
    w = events_wh(spark, sf)
    return R.bmi_evolution_report(w.fct_bmi_evolution, w.dim_date)


@query("t1_order")
def t1_order(spark, sf):
    """Every logged item with its place in the food log's order: newest day first, then meal, food name (unknown foods
    last), largest serving first, user; ties by item."""
    from ..operators.ordering import with_position
    w = events_wh(spark, sf)
    foods = w.dim_foods.select("fdc_id", F.when(F.col("description") != "Unknown", F.col("description")).alias("food_name"))
    log = w.fct_meal_logs.join(foods, "fdc_id", "left").select("user_id", "logged_date", "meal_id", "fdc_id", "food_name", "grams")
    return with_position(log, F.col("logged_date").desc(), F.col("meal_id"), F.col("food_name").asc_nulls_last(),
                         F.col("grams").desc(), F.col("user_id"), F.col("fdc_id"))


# --------------------------------------------------------------- dashboard
@query("d1_max_date")
def d1_max_date(spark, sf):
    return D.max_logged_date(orders_wh(spark, sf).fct_meal_logs)


@query("d2_users")
def d2_users(spark, sf):
    return D.user_list(events_wh(spark, sf).dim_users)


@query("d3_overview")
def d3_overview(spark, sf):
    w = events_wh(spark, sf)
    return D.user_overview(w.dim_users, w.dim_date)


@query("d4_rolling_user")
def d4_rolling_user(spark, sf):
    w = events_wh(spark, sf)
    s, e = _range(w)
    return D.nutrient_rolling(None, w.dim_nutrients, start=s, end=e, daily=w.daily_totals)


@query("d5_weekly_user")
def d5_weekly_user(spark, sf):
    w = orders_wh(spark, sf)
    s, e = _range(w)
    return D.weekly_user(None, w.dim_nutrients, start=s, end=e, daily=w.daily_totals)


@query("d6_monthly_user")
def d6_monthly_user(spark, sf):
    w = orders_wh(spark, sf)
    s, e = _range(w)
    return D.monthly_user(None, w.dim_nutrients, start=s, end=e, daily=w.daily_totals)


@query("d7_food_range")
def d7_food_range(spark, sf):
    w = events_wh(spark, sf)
    s, e = _range(w)
    return D.food_log_range(w.fct_meal_logs, w.dim_foods, w.dim_meals, start=s, end=e)


@query("d8_bmi_range")
def d8_bmi_range(spark, sf):
    w = events_wh(spark, sf)
    s, e = _range(w)
    return D.bmi_range(w.fct_bmi_evolution, w.dim_date, start=s, end=e)


@query("d9_windowed_user")
def d9_windowed_user(spark, sf):
    w = events_wh(spark, sf)
    return D.windowed_user(w.fct_user_segments_windowed, w.dim_nutrients)


@query("d10_flagged_counts")
def d10_flagged_counts(spark, sf):
    w = events_wh(spark, sf)
    s, e = _range(w)
    return D.flagged_counts(w.fct_user_segments, w.dim_nutrients, start=s, end=e)


@query("d11_first_last")
def d11_first_last(spark, sf):
    w = events_wh(spark, sf)
    s, e = _range(w)
    return D.first_last_delta(w.fct_bmi_evolution, w.dim_date, start=s, end=e)


@query("d12_week_labels")
def d12_week_labels(spark, sf):
    w = orders_wh(spark, sf)
    s, e = _range(w)
    return D.with_week_label(D.weekly_user(None, w.dim_nutrients, start=s, end=e, daily=w.daily_totals))


@query("d12_labels")
def d12_labels(spark, sf):
    w = orders_wh(spark, sf)
    s, e = _range(w)
    return D.date_labels(w.fct_meal_logs, start=s, end=e)


@query("d12_month_labels")
def d12_month_labels(spark, sf):
    w = orders_wh(spark, sf)
    s, e = _range(w)
    return D.with_month_label(D.monthly_user(None, w.dim_nutrients, start=s, end=e, daily=w.daily_totals))


@query("d13_day_meals")
def d13_day_meals(spark, sf):
    w = events_wh(spark, sf)
    s, e = _range(w)
    return D.day_meals(w.fct_meal_logs, w.dim_foods, w.dim_meals, start=s, end=e)


# ----------------------------------------------------------------- quality

FRESHNESS_AS_OF = "2024-02-01 06:00:00"


def _two_loads(spark, sf):
    """raw_foods after two monthly loads (append-only table)."""
    return fixtures.raw_foods(spark, sf).unionByName(
        fixtures.raw_foods(spark, sf, fixtures.REFETCH_LOADED_AT, refetch=True))


@query("q1_not_null")
def q1_not_null(spark, sf):
    return Q.null_counts(fixtures.raw_meal_logs(spark, sf), ["user_id", "breakfast", "lunch", "dinner", "logged_at"])


@query("q2_unique")
def q2_unique(spark, sf):
    return Q.unique(S.stg_foods(_two_loads(spark, sf)), "fdc_id")


@query("q2_new_duplicates")
def q2_new_duplicates(spark, sf):
    """Order lines stored by month; a new load brings new lines and, of two old months, some again: found by the filters."""
    from ..operators import key_filters as K
    root = scratch_dir(spark, "q2")
    li = fixtures.table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber")
    o = fixtures.table(spark, sf, "orders").select("o_orderkey", F.date_format("o_orderdate", "yyyy-MM").alias("month"))
    lines = li.join(o, li.l_orderkey == o.o_orderkey).select((F.col("l_orderkey") * 8 + F.col("l_linenumber")).alias("line_id"), "month")
    lines.hint("rebalance", "month").write.partitionBy("month").parquet(f"{root}/lines")
    stored = spark.read.schema("line_id long, month string").parquet(f"{root}/lines")
    K.write_filters(stored, f"{root}/filters", "month", "line_id")
    again = stored.where(F.col("month").isin("1996-03", "1998-11") & (F.col("line_id") % 3 == 0))
    load = again.unionByName(stored.withColumn("line_id", -F.col("line_id") - 1))
    found = K.stored_duplicates(spark, load, f"{root}/lines", f"{root}/filters", "month", "line_id")
    return found.select(F.col("key").alias("line_id"), F.col("part").cast("string").alias("month"), "stored")


@query("q3_accepted_values")
def q3_accepted_values(spark, sf):
    """The declared accepted_values test on the staged users' country (values from the data;
    a test on seed-derived labels would be folded away by the optimizer)."""
    return Q.accepted_values(events_wh(spark, sf).stg_users, "country", ["Spain"])


@query("q4_relationships")
def q4_relationships(spark, sf):
    w = orders_wh(spark, sf)
    return Q.relationships(w.fct_meal_logs, "fdc_id", w.dim_foods, "fdc_id")


@query("q5_range")
def q5_range(spark, sf):
    w = orders_wh(spark, sf)
    foods = Q.range_violations(w.dim_foods, {n: (0, 100) for n in T.NUTRIENTS}).withColumn(
        "table_name", F.lit("dim_foods"))
    logs = Q.range_violations(w.fct_meal_logs, {"grams": (0, 1000)}).withColumn("table_name", F.lit("fct_meal_logs"))
    return foods.unionByName(logs)


@query("q6_one_meal")
def q6_one_meal(spark, sf):
    return Q.no_meal_logged(events_wh(spark, sf).stg_meal_logs)


@query("q7_freshness")
def q7_freshness(spark, sf):
    w = events_wh(spark, sf)
    logs = Q.freshness(w.stg_meal_logs, "logged_at", FRESHNESS_AS_OF, *seeds.FRESHNESS_MEAL_LOGS_H,
                       source_name="app_events.raw_meal_logs")
    foods = Q.freshness(w.stg_foods, "loaded_at", FRESHNESS_AS_OF, *seeds.FRESHNESS_FOODS_H,
                        source_name="usda.raw_foods")
    return logs.unionByName(foods)


@query("q8_grain")
def q8_grain(spark, sf):
    return Q.unique(orders_wh(spark, sf).fct_meal_logs, ["user_id", "meal_id", "fdc_id", "logged_date"])


# ----------------------------------------------------------------- writes
FACT_KEY = ["user_id", "meal_id", "fdc_id", "logged_date"]
FACT_COLS = {"user_id": "long", "meal_id": "int", "fdc_id": "long", "grams": "double",
             "logged_date": "date", "logged_date_id": "int"}


def _fact(df):
    return df.select(*[F.col(c).cast(t).alias(c) for c, t in FACT_COLS.items()])


def _day(w: Warehouse, offset: int):
    return F.date_add(w.feed_span()[0], offset)


@query("i1_high_water")
def i1_high_water(spark, sf):
    """Two incremental runs of fct_meal_logs: first build, then an
    overlapping batch filtered above the high-water mark."""
    w = events_wh(spark, sf)
    items = w.fct_meal_logs
    path = scratch_dir(spark, "i1") + "/fct_meal_logs"
    W.incremental_append(items.where(F.col("logged_date") <= _day(w, 14)), path, "logged_date", ["logged_date"])
    W.incremental_append(items.where(F.col("logged_date") >= _day(w, 10)), path, "logged_date", ["logged_date"])
    return _fact(spark.read.parquet(path))


@query("i1_late_days")
def i1_late_days(spark, sf):
    """fct_meal_logs kept up to date by day sums: a first load with wrong and missing records, then newer days, late
    records and the corrected first load. Equals a full refresh."""
    from ..operators import late as L
    from .jobs import build_changed_days
    root = scratch_dir(spark, "i1-late")
    w = events_wh(spark, sf)
    day, logs = F.to_date("logged_at"), w.raw_meal_logs
    late = (F.col("user_id") % 17 == 0) & (F.dayofmonth("logged_at") % 3 == 0)
    first = logs.where((day <= _day(w, 14)) & ~late)
    wrong = (F.col("user_id") % 50 == 3) & (F.dayofmonth("logged_at") % 5 == 0)
    L.land_load(first.withColumn("lunch", F.when(~wrong, F.col("lunch"))), f"{root}/raw", "1")
    build_changed_days(w, f"{root}/raw", f"{root}/marts", "2024-01-15 06:00:00", select=["fct_meal_logs"])
    L.land_load(logs.where((day > _day(w, 14)) & ~late), f"{root}/raw", "2")
    L.land_load(logs.where(late), f"{root}/raw", "3")
    L.land_load(first, f"{root}/raw", "1")
    build_changed_days(w, f"{root}/raw", f"{root}/marts", "2024-01-31 06:00:00", select=["fct_meal_logs"])
    return _fact(spark.read.parquet(f"{root}/marts/fct_meal_logs"))


@query("i2_replace")
def i2_replace(spark, sf):
    """Reprocess mode: a corrected batch from the 11th day on replaces matching
    keys in touched days and adds the later days."""
    w = events_wh(spark, sf)
    items = w.fct_meal_logs
    path = scratch_dir(spark, "i2") + "/fct_meal_logs"
    W.merge_by_key(items.where(F.col("logged_date") <= _day(w, 14)), path, FACT_KEY, ["logged_date"])
    fix = items.where(F.col("logged_date") >= _day(w, 10)).withColumn("grams", F.col("grams") + F.lit(1.0))
    W.merge_by_key(fix, path, FACT_KEY, ["logged_date"])
    return _fact(spark.read.parquet(path))


@query("i3_full_refresh")
def i3_full_refresh(spark, sf):
    """Two full refreshes, first with the whole history, then with the last
    days only: nothing of the first stays behind."""
    w = events_wh(spark, sf)
    items = w.fct_meal_logs
    path = scratch_dir(spark, "i3") + "/fct_meal_logs"
    V.publish(items, path, ["logged_date"])
    V.publish(items.where(F.col("logged_date") >= _day(w, 14)), path, ["logged_date"])
    return _fact(V.read(spark, path))


def _snapshot(spark, sf) -> str:
    path = scratch_dir(spark, "i4") + "/dim_foods_snapshot"
    for loads, at in ((fixtures.raw_foods(spark, sf), fixtures.DEFAULT_LOADED_AT),
                      (_two_loads(spark, sf), fixtures.REFETCH_LOADED_AT)):
        foods = M.dim_foods(T.food_nutrients(S.stg_foods(loads, with_nutrients=True), latest_only=True))
        W.snapshot_check(foods, path, "fdc_id", T.NUTRIENTS, at)
    return path


@query("i4_scd2")
def i4_scd2(spark, sf):
    return M.as_double(W.read_snapshot(spark, _snapshot(spark, sf)))


@query("i5_point_in_time")
def i5_point_in_time(spark, sf):
    return M.as_double(W.as_of(W.read_snapshot(spark, _snapshot(spark, sf)), fixtures.REFETCH_LOADED_AT))


# --------------------------------------------------------------- raw loads
def _raw_rows(logs):
    """Raw log rows as comparable columns."""
    return logs.select("user_id", "logged_at", F.coalesce(F.size("breakfast"), F.lit(0)).alias("n_breakfast"),
                       F.size("lunch").alias("n_lunch"), F.size("dinner").alias("n_dinner"))


@query("a2_daily_load")
def a2_daily_load(spark, sf):
    """The raw log table after two daily loads: the second replaces the first."""
    from ..sources import raw
    w = events_wh(spark, sf)
    path = scratch_dir(spark, "a2") + "/raw_meal_logs"
    raw.load_daily_meal_logs(w.raw_meal_logs, path)
    raw.load_daily_meal_logs(w.raw_meal_logs.where(F.to_date("logged_at") >= _day(w, 14)), path)
    return _raw_rows(raw.read_raw(spark, path, "raw_meal_logs"))


@query("a3_historic_load")
def a3_historic_load(spark, sf):
    """The raw log table after a daily load and an append of the days before it."""
    from ..sources import raw
    w = events_wh(spark, sf)
    path = scratch_dir(spark, "a3") + "/raw_meal_logs"
    raw.load_daily_meal_logs(w.raw_meal_logs.where(F.to_date("logged_at") >= _day(w, 14)), path)
    raw.load_historic_meal_logs(w.raw_meal_logs.where(F.to_date("logged_at") < _day(w, 14)), path)
    return _raw_rows(raw.read_raw(spark, path, "raw_meal_logs"))


@query("a7_views")
def a7_views(spark, sf):
    """SQL over the registered model views: flagged users per segment and day."""
    events_wh(spark, sf).register_views("a7_")
    return spark.sql("""SELECT s.segment_label, s.logged_date, u.country, count(*) AS users
        FROM a7_fct_user_segments s JOIN a7_dim_users u ON s.user_id = u.user_id
        WHERE s.is_flagged GROUP BY s.segment_label, s.logged_date, u.country""")


@query("w4_windows")
def w4_windows(spark, sf):
    """The documented window idioms over each user's weigh-ins."""
    h = events_wh(spark, sf).bmi_history
    part, order = ["user_id"], ["recorded_date_id", "weight_log_id"]
    return h.select("user_id", "weight_log_id", "recorded_date_id", "bmi",
                    FW.running_total((F.col("bmi") * 10).cast("long"), part, order).alias("running_bmi"),
                    FW.next_value("bmi", part, order).alias("next_bmi"),
                    FW.previous_value("bmi", part, order).alias("previous_bmi"),
                    FW.first_value("bmi", part, order).alias("first_bmi"))


@query("w4_dedup")
def w4_dedup(spark, sf):
    """The newest weigh-in of each user, by the skew-safe de-duplication."""
    h = events_wh(spark, sf).bmi_history
    return FW.dedup_latest(h, ["user_id"], ["recorded_date_id", "weight_log_id"])


# ----------------------------------------------------------------- landing
@query("a1_land_foods")
def a1_land_foods(spark, sf):
    """API pages of 200 foods -> raw_foods rows; checked on what the JSON says."""
    landed = W.land_food_pages(fixtures.food_pages(spark, sf), fixtures.DEFAULT_LOADED_AT + "+00:00")
    j = F.col("raw_json")
    return landed.select(
        "fdc_id", instant_to_utc("loaded_at").alias("loaded_at"),
        F.get_json_object(j, "$.description").alias("description"),
        F.json_array_length(F.get_json_object(j, "$.foodNutrients")).alias("n_nutrients"))


@query("a1_quarantine")
def a1_quarantine(spark, sf):
    """Faulty pages landed: rows per page in the raw table (no reason) and in the quarantine, by reason."""
    from ..operators import landing as L
    root = scratch_dir(spark, "a1")
    L.load_food_pages(fixtures.faulty_pages(spark, sf), f"{root}/raw_foods", f"{root}/quarantine", fixtures.DEFAULT_LOADED_AT + "+00:00")
    page = F.concat(F.lit("page-"), F.floor(F.col("fdc_id") / 200).cast("string")).alias("file")
    good = spark.read.parquet(f"{root}/raw_foods").select(page, F.lit(None).cast("string").alias("reason"))
    bad = spark.read.parquet(f"{root}/quarantine").select("file", "reason")
    return good.unionByName(bad).groupBy("file", "reason").agg(F.count(F.lit(1)).alias("n"))


# --------------------------------------------------------------- streaming
@query("x1_stream_daily")
def x1_stream_daily(spark, sf):
    """Land the raw meal-log feed as files in three loads, the middle days first
    and the oldest last, run the streaming job to completion after each load
    with one file per trigger, and read its sink."""
    from ..streaming.meal_stream import read_daily, run_daily_intake_stream
    root = scratch_dir(spark, "x1")
    w = events_wh(spark, sf)
    w.dim_foods.write.parquet(f"{root}/foods")
    foods = spark.read.parquet(f"{root}/foods")
    day = F.to_date("logged_at")
    for lo, hi in ((10, 19), (20, None), (None, 9)):
        part = w.raw_meal_logs
        part = part if lo is None else part.where(day >= _day(w, lo))
        part = part if hi is None else part.where(day <= _day(w, hi))
        part.coalesce(2).write.mode("append").parquet(f"{root}/landing")
        run_daily_intake_stream(spark, f"{root}/landing", foods, f"{root}/daily", f"{root}/_checkpoint",
                                max_files_per_trigger=1)
    return M.as_double(read_daily(spark, f"{root}/daily"))


@query("x1_stateful_daily")
def x1_stateful_daily(spark, sf):
    """As x1_stream_daily, with state: a watermark of two days, the oldest days late, the stream restarted twice."""
    from ..streaming.stateful_stream import read_daily, run_daily_intake
    root = scratch_dir(spark, "x1-state")
    w = events_wh(spark, sf)
    w.dim_foods.write.parquet(f"{root}/foods")
    foods, day = spark.read.parquet(f"{root}/foods"), F.to_date("logged_at")
    for lo, hi in ((8, 17), (18, None), (None, 7)):
        part = w.raw_meal_logs
        part = part if lo is None else part.where(day >= _day(w, lo))
        part = part if hi is None else part.where(day <= _day(w, hi))
        part.coalesce(1).write.mode("append").parquet(f"{root}/landing")
        run_daily_intake(spark, f"{root}/landing", foods, f"{root}/daily", f"{root}/_checkpoint", max_files_per_trigger=1)
    return M.as_double(read_daily(spark, f"{root}/daily"))


@query("a6_food_ids")
def a6_food_ids(spark, sf):
    """Valid food keys of the raw table after two monthly loads."""
    from ..sources.raw import food_ids
    return food_ids(_two_loads(spark, sf))


# ------------------------------------------------------------- daily build
SEG_COLS = {"user_id": "long", "nutrient_id": "int", "logged_date": "date", "logged_date_id": "int",
            "daily_value_g": "double", "threshold_g": "double", "threshold_type": "string",
            "segment_label": "string", "is_flagged": "boolean"}


@query("a9_incremental_segments")
def a9_incremental_segments(spark, sf):
    """Two daily builds of the whole star schema: first with the feed up to its
    15th day, then with the full feed. The incrementally grown segment fact
    equals a full refresh (no late data in this feed)."""
    from .jobs import build_marts
    root = scratch_dir(spark, "a9")
    full = events_wh(spark, sf)
    cut = _day(full, 14)
    first_logs = full.raw_meal_logs.where(F.to_date("logged_at") <= cut)
    first = events_wh(spark, sf, raw_meal_logs=first_logs,
                      feed_dates=full.feed_dates.where(F.col("day") <= cut))
    build_marts(first, root, "2024-01-15 06:00:00", select=["fct_user_segments"])
    build_marts(full, root, "2024-01-31 06:00:00", select=["fct_user_segments"])
    seg = spark.read.parquet(f"{root}/fct_user_segments")
    return seg.select(*[F.col(c).cast(t).alias(c) for c, t in SEG_COLS.items()])


@query("c8_accumulated")
def c8_accumulated(spark, sf):
    """The windowed mart of a daily run whose feed holds the last day only: the
    averages come from the nutrient fact that the first, full build left."""
    from .jobs import build_marts
    root = scratch_dir(spark, "c8")
    full = events_wh(spark, sf)
    marts = ["fct_meal_log_nutrients", "fct_user_segments_windowed"]
    build_marts(full, root, "2024-01-31 06:00:00", select=marts)
    last = full.feed_span()[1]
    daily = events_wh(spark, sf, raw_meal_logs=full.raw_meal_logs.where(F.to_date("logged_at") == last),
                      feed_dates=full.feed_dates.where(F.col("day") == last))
    build_marts(daily, root, "2024-01-31 07:00:00", select=marts)
    return V.read(spark, f"{root}/fct_user_segments_windowed")


@query("q9_mart_tests")
def q9_mart_tests(spark, sf):
    """Every declared data test of the marts, after materialising them once."""
    w = events_wh(spark, sf)
    names = sorted({m for m, *_ in Q.MART_TESTS} | {a[0] for *_, a in Q.MART_TESTS if isinstance(a, tuple)
                                                     and isinstance(a[0], str)})
    w.materialize("food_nutrients", "users_bmi", "bmi_history", "items").materialize("scaled_exact").materialize("daily_wide")
    return Q.mart_tests({n: getattr(w, n) for n in names})


@query("q10_model_tests")
def q10_model_tests(spark, sf):
    """Every declared data test of the staging and intermediate models."""
    w = events_wh(spark, sf)
    w.materialize("food_nutrients", "users_bmi", "bmi_history", "items").materialize("scaled_exact").materialize("daily_wide")
    names = sorted({m for m, *_ in Q.MODEL_TESTS})
    return Q.mart_tests({n: getattr(w, n) for n in names}, Q.MODEL_TESTS)


@query("q11_snapshot_tests")
def q11_snapshot_tests(spark, sf):
    """The declared tests of the SCD2 food snapshot, after two snapshot runs."""
    return Q.mart_tests({"dim_foods_snapshot": W.read_snapshot(spark, _snapshot(spark, sf))}, Q.SNAPSHOT_TESTS)
