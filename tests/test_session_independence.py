"""Results do not depend on the session time zone or the shuffle width."""

import pytest

import __spark_entry__ as E
from paths import SF_SMALL

KEYS = ["b1_stg_foods", "b2_stg_users", "b3_stg_weights", "b4_stg_meal_logs", "c1_food_pivot", "c5_user_bmi",
        "c7_segments", "c8_windowed", "q7_freshness", "a1_land_foods", "r10_bmi", "i4_scd2", "d12_week_labels"]


def rows(spark, key):
    return sorted(map(repr, E.queries()[key](spark, SF_SMALL).collect()))


@pytest.mark.parametrize("key", KEYS)
def test_same_answer_in_another_time_zone(spark, key):
    base = rows(spark, key)
    old_tz = spark.conf.get("spark.sql.session.timeZone")
    old_sp = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/Los_Angeles")
        spark.conf.set("spark.sql.shuffle.partitions", "3")
        other = rows(spark, key)
    finally:
        spark.conf.set("spark.sql.session.timeZone", old_tz)
        spark.conf.set("spark.sql.shuffle.partitions", old_sp)
    assert other == base


@pytest.mark.parametrize("key", ["c1_food_pivot", "c3_scaled", "c7_segments", "r3_mom", "q9_mart_tests"])
def test_same_answer_without_ansi_mode(spark, key):
    base = rows(spark, key)
    old = spark.conf.get("spark.sql.ansi.enabled")
    try:
        spark.conf.set("spark.sql.ansi.enabled", "false")
        other = rows(spark, key)
    finally:
        spark.conf.set("spark.sql.ansi.enabled", old)
    assert other == base
