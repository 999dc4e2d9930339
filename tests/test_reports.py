"""Reports computed from the meal-grain fact equal those from daily totals."""

from datetime import date
from decimal import Decimal

import pytest

from paths import SF_SMALL
from platewise.functions import date_id
from platewise.operators import transforms as T
from platewise.plans import catalog
from platewise.plans import dashboard as D
from platewise.plans import reports as R
from platewise.plans.build import Warehouse


@pytest.fixture(scope="module")
def wh(spark):
    return Warehouse.from_testdata(spark, SF_SMALL, "events")


def same(a, b):
    ra = sorted(map(tuple, a.collect()), key=repr)
    rb = sorted(map(tuple, b.collect()), key=repr)
    assert ra == rb and len(ra) > 0


def test_fact_path_equals_daily_path(wh):
    f, n = wh.fct_meal_log_nutrients, wh.dim_nutrients
    same(R.daily_intake_report(f, n), R.daily_intake_report(None, n, daily=wh.daily_totals))
    same(R.weekly_average_report(f, n), R.weekly_average_report(None, n, daily=wh.daily_totals))
    same(R.monthly_mom_report(f, n), R.monthly_mom_report(None, n, daily=wh.daily_totals))
    same(R.rolling_report(f, n, wh.dim_date), R.rolling_report(None, n, wh.dim_date, daily=wh.daily_totals))
    s, e = wh.feed_span()
    same(D.nutrient_rolling(f, n, start=s, end=e), D.nutrient_rolling(None, n, start=s, end=e, daily=wh.daily_totals))


def test_monthly_report_of_wide_days_equals_that_of_long_days(spark, wh):
    n = wh.dim_nutrients
    same(R.monthly_mom_report(None, n, wide=wh.totals_wide), R.monthly_mom_report(None, n, daily=wh.daily_totals))
    rows = [(u, 1, f, g, date(2024, m, d)) for u, f, g, m, d in [
        (1, 10, 100.0, 1, 3), (1, 10, 0.12345678, 1, 3), (1, 11, 2e9, 1, 9), (1, 10, 1e17, 2, 1), (1, 10, None, 3, 1), (1, 11, 5.5, 4, 30),
        (2, 11, 1e-9, 1, 1), (2, 11, 7.0, 6, 1), (None, 10, 3.0, 6, 1), (None, 10, 4.0, 7, 1)]]
    items = spark.createDataFrame(rows, "user_id long, meal_id int, fdc_id long, grams double, logged_date date").withColumn(
        "logged_date_id", date_id("logged_date"))
    foods = spark.createDataFrame([(10, *map(Decimal, "12.5 0 3.1 4.00004 7".split())), (11, *map(Decimal, "1 2 3 4 5".split()))],
                                  "fdc_id long, " + ", ".join(f"{c} decimal(18,5)" for c in T.NUTRIENTS))
    scaled = T.scaled_exact(items, foods)
    same(R.monthly_mom_report(None, n, wide=T.totals_wide(scaled)), R.monthly_mom_report(None, n, daily=T.daily_totals(scaled)))


def test_months_are_moved_before_they_are_unpivoted(spark):
    plan = catalog.QUERIES["r3_mom"](spark, SF_SMALL)._jdf.queryExecution().executedPlan().toString()
    assert -1 < plan.index("Generate") < plan.index("Window [")


def test_user_filter_is_a_predicate(wh):
    n = wh.dim_nutrients
    one = D.weekly_user(wh.fct_meal_log_nutrients, n, users=[1, 2]).collect()
    assert {r.user_id for r in one} <= {1, 2}


def test_windowed_from_fact_equals_default_on_a_full_feed(spark):
    a = Warehouse.from_testdata(spark, SF_SMALL, "events").fct_user_segments_windowed
    fact = Warehouse.from_testdata(spark, SF_SMALL, "events").fct_meal_log_nutrients
    b = Warehouse.from_testdata(spark, SF_SMALL, "events", nutrient_fact=fact).fct_user_segments_windowed
    same(a, b)


def test_null_flags_count_as_not_flagged(spark):
    import datetime as dt
    from platewise.plans import dashboard as D
    from platewise.sources import seeds
    seg = spark.createDataFrame([
        (1, 1, dt.date(2024, 1, 2), 20240102, 10.0, 50.0, "min", "low_protein", True),
        (2, 1, dt.date(2024, 1, 2), 20240102, 60.0, 50.0, "target", "low_protein", None),
        (2, 2, dt.date(2024, 1, 1), 20240101, 90.0, 78.0, "max", "high_fat", True),
    ], "user_id long, nutrient_id int, logged_date date, logged_date_id int, daily_value_g double, "
       "threshold_g double, threshold_type string, segment_label string, is_flagged boolean")
    piv = {r.user_id: (r.low_protein, r.high_fat) for r in R.segment_pivot_report(seg).collect()}
    assert piv == {1: (True, False), 2: (False, False)}          # latest day only; NULL -> false
    counts = {(r.nutrient_name, r.logged_date): (r.total_users, r.flagged_users)
              for r in D.flagged_counts(seg, seeds.nutrients(spark)).collect()}
    assert counts[("Protein", dt.date(2024, 1, 2))] == (2, 1)
