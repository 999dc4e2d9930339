"""Tiny literal golden cases for the edge rules (N1-N4, FIXTURES edge rows)."""

import datetime as dt
import json
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from platewise import schemas
from platewise.operators import marts as M
from platewise.operators import staging as S
from platewise.operators import transforms as T
from platewise.sources import seeds

D = dt.date
TS = dt.datetime


def raw_foods(spark, docs, loaded_at="2024-02-01 00:00:00"):
    rows = [(d.get("fdcId", i), json.dumps(d) if isinstance(d, dict) else d) for i, d in enumerate(docs)]
    df = spark.createDataFrame(rows, "fdc_id long, raw_json string")
    return df.select("fdc_id", F.to_timestamp(F.lit(loaded_at)).alias("loaded_at"), "raw_json")


def nut(number, amount):
    return {"number": number, "amount": amount}


# ------------------------------------------------------------------ B1 / C1
def test_c1_json_edges(spark):
    docs = [
        {"fdcId": 1, "description": "apple", "publicationDate": "2019-04-01",
         "foodNutrients": [nut("203", "1.5"), nut("204", 2), nut(205, "3.25"), nut("269", "n/a"),
                           nut("203", "0.5"), nut("999", "7")]},
        {"fdcId": 2, "publicationDate": "2020-01-02", "foodNutrients": []},          # disappears
        {"fdcId": 3, "publicationDate": "2020-01-02"},                                # no list: disappears
        {"fdcId": 4, "publicationDate": "2020-01-02", "foodNutrients": [nut("301", "9")]},  # all zero
    ]
    st = S.stg_foods(raw_foods(spark, docs))
    got = {r.fdc_id: r for r in T.food_nutrients(st).collect()}
    assert sorted(got) == [1, 4]
    a = got[1]
    assert a.description == "apple"
    assert a.publication_date_id == 20190401 and a.loaded_date_id == 20240201
    assert (a.protein_g, a.fat_g, a.carbohydrate_g) == (Decimal("1.5"), Decimal("2"), Decimal("3.25"))
    assert a.total_sugar_g == 0 and a.fiber_g == 0          # "n/a" -> NULL -> 0; absent -> 0
    assert got[4].protein_g == 0
    desc = {r.fdc_id: r.description for r in st.collect()}
    assert desc[2] == "Unknown"                              # missing description


def test_b1_bad_publication_date_fails(spark):
    st = S.stg_foods(raw_foods(spark, [{"fdcId": 1, "publicationDate": "4/1/2019", "foodNutrients": []}]))
    with pytest.raises(Exception):
        st.collect()


def test_c1_latest_only_keeps_newest_load(spark):
    doc1 = {"fdcId": 7, "publicationDate": "2019-04-01", "foodNutrients": [nut("203", "1")]}
    doc2 = {"fdcId": 7, "publicationDate": "2019-04-01", "foodNutrients": [nut("203", "2")]}
    raw = raw_foods(spark, [doc1]).unionByName(raw_foods(spark, [doc2], "2024-03-01 00:00:00"))
    both = T.food_nutrients(S.stg_foods(raw)).collect()
    assert len(both) == 2                                     # the reference's double-count hazard
    latest = T.food_nutrients(S.stg_foods(raw), latest_only=True).collect()
    assert [(r.fdc_id, r.protein_g) for r in latest] == [(7, Decimal("2"))]


# ------------------------------------------------------------------ B4 / C2
def logs(spark, rows):
    return spark.createDataFrame(rows, schemas.RAW_MEAL_LOGS)


def test_b4_c2_null_and_empty_arrays(spark):
    rows = [
        (1, None, [], [(10, 100.0), (11, None), (None, 50.0)], TS(2024, 1, 15, 0, 30)),
        (2, [(10, 80.0)], None, None, TS(2024, 1, 15, 12, 0)),
        (3, None, None, None, TS(2024, 1, 15, 12, 0)),
    ]
    st = S.stg_meal_logs(logs(spark, rows))
    sizes = {r.user_id: (len(r.breakfast), len(r.lunch), len(r.dinner)) for r in st.collect()}
    assert sizes == {1: (0, 0, 3), 2: (1, 0, 0), 3: (0, 0, 0)}
    items = sorted(tuple(r) for r in T.meal_items(st).collect())
    assert items == [(1, 3, 10, 100.0, D(2024, 1, 15), 20240115), (2, 1, 10, 80.0, D(2024, 1, 15), 20240115)]


def test_b4_time_zone_parameter_moves_day(spark):
    rows = [(1, [(10, 100.0)], None, None, TS(2024, 1, 15, 0, 30))]
    items = T.meal_items(S.stg_meal_logs(logs(spark, rows), tz="Europe/Madrid")).collect()
    assert items[0].logged_date == D(2024, 1, 14)


def test_c1_merges_documents_of_one_food_and_load(spark):
    def doc(nutrients, description="x"):
        import json
        return json.dumps({"fdcId": 1, "description": description, "publicationDate": "2020-01-01", "foodNutrients": [
            {"number": n, "amount": a} for n, a in nutrients]})
    first, later = TS(2024, 2, 1), TS(2024, 3, 1)
    raw = spark.createDataFrame([
        (1, first, doc([("203", "5"), ("204", 1.23456789)])), (1, first, doc([("203", 9), ("205", "n/a"), ("291", "2.5e8")])),
        (2, first, doc([("203", "0.00004")])), (2, first, doc([("203", "0.00003")], "y")), (2, later, doc([("203", "7")]))],
        "fdc_id long, loaded_at timestamp_ntz, raw_json string")
    for with_nutrients in (False, True):
        foods = S.stg_foods(raw, with_nutrients=with_nutrients)
        got = sorted((r.fdc_id, r.description, r.loaded_date_id, float(r.protein_g), float(r.fat_g), float(r.carbohydrate_g),
                      float(r.fiber_g)) for r in T.food_nutrients(foods).collect())
        assert got == [(1, "x", 20240201, 9.0, 1.23456789, 0.0, 2.5e8), (2, "x", 20240201, 0.00004, 0, 0, 0),
                       (2, "x", 20240301, 7.0, 0, 0, 0), (2, "y", 20240201, 0.00003, 0, 0, 0)]
        newest = T.food_nutrients(foods, latest_only=True).collect()
        assert sorted((r.fdc_id, float(r.protein_g)) for r in newest) == [(1, 9.0), (2, 7.0)]


# --------------------------------------------------------------- C3 / C4
def test_c3_c4_scaling_unknown_food_and_window(spark):
    foods = spark.createDataFrame([(10, Decimal("10"), Decimal("5"), Decimal("0"), Decimal("1"), Decimal("2"))],
                                  "fdc_id long, protein_g decimal(20,10), fat_g decimal(20,10), "
                                  "carbohydrate_g decimal(20,10), fiber_g decimal(20,10), total_sugar_g decimal(20,10)")
    items = spark.createDataFrame([
        (1, 1, 10, 150.0, D(2024, 1, 10), 20240110),
        (1, 2, 10, 50.0, D(2024, 1, 10), 20240110),
        (1, 2, 99, 50.0, D(2024, 1, 10), 20240110),      # unknown food: dropped
        (1, 1, 10, 100.0, D(2022, 1, 10), 20220110),     # older than 365 days: outside C4
    ], "user_id long, meal_id int, fdc_id long, grams double, logged_date date, logged_date_id int")
    sc = T.scaled_nutrients(items, foods)
    assert sc.count() == 3
    grams = sorted(r.protein_g for r in sc.collect())
    assert grams == [Decimal("5"), Decimal("10"), Decimal("15")]
    daily = {(r.nutrient_id, r.logged_date): r.daily_value_g
             for r in T.daily_intake(sc, "2024-01-10").collect()}
    assert daily[(1, D(2024, 1, 10))] == Decimal("20")   # 10 g/100 g * 200 g
    assert daily[(2, D(2024, 1, 10))] == Decimal("10")
    assert (1, D(2022, 1, 10)) not in daily
    mln = M.fct_meal_log_nutrients(sc).where("nutrient_id = 1").collect()
    assert sorted((r.meal_id, r.logged_date, r.value_g) for r in mln) == [
        (1, D(2022, 1, 10), Decimal("10")), (1, D(2024, 1, 10), Decimal("15")), (2, D(2024, 1, 10), Decimal("5"))]


# ------------------------------------------------------------------ C5 / C6
def users_df(spark, rows):
    return spark.createDataFrame(rows, "user_id long, country string, birth_date date, height_cm double, "
                                       "registered_at timestamp")


def weights_df(spark, rows):
    return S.stg_weight_logs(spark.createDataFrame(rows, "user_id long, weight_kg double, recorded_at timestamp_ntz"))


def test_c5_bands_ties_and_missing_weight(spark):
    u = users_df(spark, [(1, "ES", D(1990, 1, 1), 100.0, TS(2026, 5, 1)),
                         (2, "ES", D(1990, 1, 1), 100.0, TS(2026, 5, 1)),
                         (3, "ES", D(1990, 1, 1), 100.0, TS(2026, 5, 1)),
                         (4, "ES", D(1990, 1, 1), 100.0, TS(2026, 5, 1)),
                         (5, "ES", D(1990, 1, 1), 100.0, TS(2026, 5, 1))])   # 5: no weight
    t = TS(2026, 6, 1, 9)
    w = weights_df(spark, [(1, 18.5, t), (2, 25.0, t), (3, 30.0, t), (4, 10.0, TS(2026, 5, 1)), (4, 18.4, t)])
    got = {r.user_id: (r.bmi, r.bmi_category) for r in T.users_with_bmi(u, w).collect()}
    assert got == {1: (18.5, "Normal weight"), 2: (25.0, "Overweight"), 3: (30.0, "Obese"),
                   4: (18.4, "Underweight")}


def test_c5_tie_on_recorded_at_is_deterministic(spark):
    u = users_df(spark, [(1, "ES", D(1990, 1, 1), 100.0, TS(2026, 5, 1))])
    t = TS(2026, 6, 1, 9)
    w = weights_df(spark, [(1, 60.0, t), (1, 70.0, t)])
    ids = {r.weight_kg: r.weight_log_id for r in w.collect()}
    expect = max(ids.items(), key=lambda kv: kv[1])[0]
    assert T.users_with_bmi(u, w).first().weight_kg == expect


def test_c6_history_every_weigh_in(spark):
    u = users_df(spark, [(1, "ES", D(1990, 1, 1), 162.0, TS(2026, 5, 1))])
    w = weights_df(spark, [(1, 62.0, TS(2026, 5, 1, 7, 23)), (1, 61.2, TS(2026, 6, 1, 7))])
    got = sorted((r.recorded_date_id, r.bmi) for r in T.bmi_history(w, u).collect())
    assert got == [(20260501, 23.6), (20260601, 23.3)]


# ------------------------------------------------------------------ C7 / C8
def daily_df(spark, rows):
    return spark.createDataFrame(rows, "user_id long, nutrient_id int, logged_date date, logged_date_id int, "
                                       "daily_value_g decimal(38,10)")


def test_c7_rounds_before_compare_and_target_type_is_null(spark):
    ub = spark.createDataFrame([(1, 62.5)], "user_id long, weight_kg double")
    daily = daily_df(spark, [(1, 1, D(2024, 1, 1), 20240101, Decimal("49.995")),   # rounds to 50.00
                             (1, 2, D(2024, 1, 1), 20240101, Decimal("78.004")),   # rounds to 78.00
                             (1, 3, D(2024, 1, 1), 20240101, Decimal("300"))])     # no segment
    targets = seeds.nutrient_daily_targets(spark).withColumn(
        "threshold_type", F.when(F.col("nutrient_id") == 4, "target").otherwise(F.col("threshold_type")))
    daily = daily.unionByName(daily_df(spark, [(1, 4, D(2024, 1, 1), 20240101, Decimal("1"))]))
    got = {r.nutrient_id: r for r in T.nutrient_segments(T.to_wide(daily, "daily_value_g"), ub, targets).collect()}
    assert 3 not in got                                         # carbohydrate has no segment
    assert got[1].threshold_g == 50.0 and got[1].daily_value_g == 50.0 and got[1].is_flagged is False
    assert got[2].daily_value_g == 78.0 and got[2].is_flagged is False
    assert got[4].is_flagged is None                            # N4


def test_c8_windows_skip_unlogged_days_and_idle_users(spark):
    ub = spark.createDataFrame([(1, 70.0), (2, 70.0)], "user_id long, weight_kg double")
    rows = [(1, 2, D(2024, 1, 30), 20240130, Decimal("100")),
            (1, 2, D(2024, 1, 26), 20240126, Decimal("50")),     # inside 7 days
            (1, 2, D(2024, 1, 10), 20240110, Decimal("30")),     # inside 30 days only
            (2, 2, D(2023, 11, 1), 20231101, Decimal("500"))]    # idle > 30 days: gone
    got = T.segments_windowed(T.to_wide(daily_df(spark, rows), "daily_value_g"), ub, "2024-01-30").collect()
    assert len(got) == 1
    r = got[0]
    assert r.reference_date == D(2024, 1, 30) and r.last_day_g == 100.0
    assert r.last_7d_avg_g == 75.0 and r.last_30d_avg_g == 60.0   # N1: gaps are not zeros
    assert (r.is_flagged_last_day, r.is_flagged_last_7d, r.is_flagged_last_30d) == (True, False, False)


# ----------------------------------------------------------------------- M1
def test_dim_date_default_span_and_attributes(spark):
    d = M.dim_date(spark)
    assert d.count() == 3286                                   # end exclusive: 2019-01-01 .. 2027-12-30
    r = d.where("full_date = date'2024-01-07'").first()
    assert (r.date_id, r.day_of_week, r.day_name, r.month_name, r.is_weekend) == (20240107, 0, "Sunday", "January", True)
    assert d.where("full_date = date'2027-01-01'").first().week_of_year == 53
    assert M.dim_date(spark, end_inclusive=True).count() == 3287


def test_dim_users_recommended_protein(spark):
    ub = spark.createDataFrame([(1, "ES", D(1990, 3, 14), 61.2, 162.0, 23.3, "Normal weight", 20260501)],
                               "user_id long, country string, birth_date date, weight_kg double, height_cm double, "
                               "bmi double, bmi_category string, registered_date_id int")
    assert M.dim_users(ub).first().recommended_protein_g == 49.0
