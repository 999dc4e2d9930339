"""Data-quality checks Q1-Q8 on literal frames."""

import datetime as dt

from platewise import schemas
from platewise.operators import quality as Q


def test_null_counts_unique_values_range(spark):
    df = spark.createDataFrame([(1, "a", 5.0), (1, None, 150.0), (None, "z", -1.0), (2, "b", None)],
                               "k long, label string, v double")
    assert {r.column_name: r.failures for r in Q.null_counts(df).collect()} == {"k": 1, "label": 1, "v": 1}
    assert [tuple(r) for r in Q.unique(df, "k").collect()] == [(1, 2)]
    assert sorted(tuple(r) for r in Q.accepted_values(df, "label", ["a", "b"]).collect()) == [("z", 1)]
    assert sorted(r.v for r in Q.accepted_range(df, "v", 0, 100).collect()) == [-1.0, 150.0]
    assert {r.column_name: r.failures for r in Q.range_violations(df, {"v": (0, 100)}).collect()} == {"v": 2}
    assert Q.unique(df, ["k", "label"]).count() == 0


def test_relationships_anti_join(spark):
    child = spark.createDataFrame([(1,), (2,), (None,), (2,)], "fdc_id long")
    parent = spark.createDataFrame([(1,)], "fdc_id long")
    assert sorted(r.from_field for r in Q.relationships(child, "fdc_id", parent, "fdc_id").collect()) == [2, 2]


def test_no_meal_logged(spark):
    ts = dt.datetime(2024, 1, 1, 12)
    df = spark.createDataFrame([(1, None, [], None, ts), (2, [(1, 1.0)], None, None, ts)], schemas.RAW_MEAL_LOGS)
    assert [r.user_id for r in Q.no_meal_logged(df).collect()] == [1]


def test_freshness_levels(spark):
    df = spark.createDataFrame([(dt.datetime(2024, 1, 1, 0),)], "ts timestamp_ntz")
    st = lambda as_of: Q.freshness(df, "ts", as_of, 12, 25, "s").first()
    assert st("2024-01-01 06:00:00").status == "pass"
    assert st("2024-01-01 13:00:00").status == "warn"
    assert st("2024-01-02 02:00:00").status == "error"
    assert st("2024-01-01 13:00:00").age_hours == 13.0


def test_summary(spark):
    df = spark.createDataFrame([(1,), (1,)], "k long")
    got = {r.check_name: r.failures for r in Q.summary({"u": Q.unique(df, "k"), "n": Q.not_null(df, "k")}).collect()}
    assert got == {"u": 1, "n": 0}
