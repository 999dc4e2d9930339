"""Golden cases for the Column helpers (F/U rows of the inventory)."""

import datetime as dt
import hashlib

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from platewise import functions as PF


def one(spark, col):
    return spark.range(1).select(col.alias("x")).first()["x"]


def test_round_matches_warehouse_not_spark(spark):
    # the warehouse rounds 1.005 down (binary value below the tie)
    assert one(spark, PF.round_half_away(F.lit(1.005), 2)) == 1.0
    assert one(spark, F.round(F.lit(1.005), 2)) == 1.01  # Spark's own rule differs
    assert one(spark, PF.round_half_away(F.lit(2.5), 0)) == 3.0
    assert one(spark, PF.round_half_away(F.lit(-2.5), 0)) == -3.0


def test_bmi_golden(spark):
    # seed user 1: latest weight 61.2 kg, 162 cm -> 23.3; protein target 49.0
    assert one(spark, PF.bmi(F.lit(61.2), F.lit(162.0))) == 23.3
    assert one(spark, PF.round_half_away(F.lit(61.2) * F.lit(0.8), 1)) == 49.0
    assert one(spark, PF.bmi(F.lit(61.2), F.lit(0.0))) is None  # no divide-by-zero failure


def test_date_id(spark):
    assert one(spark, PF.date_id(F.lit("2024-01-07").cast("date"))) == 20240107


def test_surrogate_key_matches_md5_of_joined_strings(spark):
    got = one(spark, PF.surrogate_key(F.lit(1), F.lit(61.6), F.lit("2026-05-01 07:23:00").cast("timestamp_ntz")))
    assert got == hashlib.md5(b"1-61.6-2026-05-01 07:23:00").hexdigest()
    got_null = one(spark, PF.surrogate_key(F.lit(1), F.lit(None).cast("double")))
    assert got_null == hashlib.md5(b"1-_dbt_utils_surrogate_key_null_").hexdigest()


def test_naive_local_time_moves_to_previous_utc_day(spark):
    # a 00:30 log in Madrid (UTC+1 in winter) belongs to the previous UTC day
    ts = F.lit("2024-01-15 00:30:00").cast("timestamp_ntz")
    got = one(spark, PF.naive_to_utc(ts, "Europe/Madrid"))
    assert got == dt.datetime(2024, 1, 14, 23, 30)


def test_instant_to_utc_ignores_session_zone(spark):
    old = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/New_York")
        got = one(spark, PF.instant_to_utc(F.to_timestamp(F.lit("2026-05-01 09:23:14+02:00"))))
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)
    assert got == dt.datetime(2026, 5, 1, 7, 23, 14)


@settings(max_examples=40, deadline=None)
@given(st.dates(min_value=dt.date(1990, 1, 1), max_value=dt.date(2035, 12, 31)))
def test_week_label_is_python_strftime_W(spark, d):
    got = one(spark, PF.week_label(F.lit(d)))
    assert got == d.strftime("%Y-W%W")


def test_month_label(spark):
    assert one(spark, PF.month_label(F.lit(dt.date(2024, 1, 31)))) == "Jan 2024"


def test_week_start_is_monday(spark):
    assert one(spark, PF.week_start(F.lit(dt.date(2024, 1, 7)))) == dt.date(2024, 1, 1)


def test_threshold_flag_target_type_is_null(spark):
    f = PF.threshold_flag(F.lit("target"), F.lit(1.0), F.lit(2.0))
    assert one(spark, f) is None
    assert one(spark, PF.threshold_flag(F.lit("min"), F.lit(1.0), F.lit(2.0))) is True
    assert one(spark, PF.threshold_flag(F.lit("max"), F.lit(1.0), F.lit(2.0))) is False


def test_scaled_grams_are_exact(spark):
    from decimal import Decimal
    # 13.7 g per 100 g x 95 g = 13.015 g exactly (a rounding tie at 2 decimals)
    g = PF.scaled_grams(PF.per_gram(F.lit(Decimal("13.7"))), F.lit(95.0))
    assert one(spark, g) == Decimal("13.015")
    assert one(spark, PF.round_exact(g, 2)) == Decimal("13.02")
    for amount, grams, want in (("0.00004", 50.0, "0.00002"), ("1.23456789", 123.45, "1.5240740602050"),
                                ("2.5E8", 200.0, "500000000"), ("9999999999.9999999999", 100.0, "9999999999.9999999999")):
        assert one(spark, PF.scaled_grams(PF.per_gram(F.lit(amount)), F.lit(grams))) == Decimal(want)


def test_window_idioms_and_dedup(spark):
    from platewise.functions import windows as WF
    df = spark.createDataFrame([(1, 1, 5.0), (1, 2, 7.0), (1, 3, 1.0), (2, 1, 4.0), (2, 1, 9.0)],
                               "k long, d int, v double")
    got = df.select("k", "d", "v",
                    WF.running_total("v", ["k"], ["d", "v"]).alias("run"),
                    WF.next_value("v", ["k"], ["d", "v"]).alias("nxt"),
                    WF.previous_value("v", ["k"], ["d", "v"]).alias("prv"),
                    WF.first_value("v", ["k"], ["d", "v"]).alias("fst")).where("k = 1").orderBy("d").collect()
    assert [(r.run, r.nxt, r.prv, r.fst) for r in got] == [(5.0, 7.0, None, 5.0), (12.0, 1.0, 5.0, 5.0),
                                                           (13.0, None, 7.0, 5.0)]
    dd = {r.k: (r.d, r.v) for r in WF.dedup_latest(df, ["k"], ["d", "v"]).collect()}
    assert dd == {1: (3, 1.0), 2: (1, 9.0)}
