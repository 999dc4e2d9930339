"""The daily build: two incremental runs of every mart equal one full refresh."""

import re

from paths import SF_SMALL
from pyspark.sql import functions as F

from platewise.plans.build import Warehouse
from platewise.plans.jobs import ALL_MARTS, FACTS, build_marts, read_marts


def rows(df):
    return sorted(map(repr, df.select(*sorted(df.columns)).collect()))


def test_two_daily_builds_equal_full_refresh(spark, scratch):
    full = Warehouse.from_testdata(spark, SF_SMALL, "events")
    cut = F.date_add(full.feed_span()[0], 14)
    first = Warehouse.from_testdata(spark, SF_SMALL, "events",
                                    raw_meal_logs=full.raw_meal_logs.where(F.to_date("logged_at") <= cut),
                                    feed_dates=full.feed_dates.where(F.col("day") <= cut))
    inc, ref = f"{scratch}/inc", f"{scratch}/ref"
    build_marts(first, inc, "2024-01-15 06:00:00")
    build_marts(Warehouse.from_testdata(spark, SF_SMALL, "events"), inc, "2024-01-31 06:00:00")
    build_marts(Warehouse.from_testdata(spark, SF_SMALL, "events"), ref, "2024-01-31 06:00:00", full_refresh=True)
    a, b = read_marts(spark, inc), read_marts(spark, ref)
    assert set(a) == set(ALL_MARTS)
    for name in FACTS:
        assert rows(a[name]) == rows(b[name]), name
    # the snapshot saw two runs; food values did not change, so one open version per food
    snap = a["dim_foods_snapshot"]
    assert snap.where("dbt_valid_to IS NOT NULL").count() == 0
    assert snap.count() == b["dim_foods"].count()


def test_reports_on_persisted_marts_prune_partitions(spark, scratch):
    from platewise.plans import reports as R
    w = Warehouse.from_testdata(spark, SF_SMALL, "events")
    root = f"{scratch}/marts"
    build_marts(w, root, "2024-01-31 06:00:00", select=["fct_user_segments", "dim_nutrients"])
    m = read_marts(spark, root)
    rep = R.latest_segments_report(m["fct_user_segments"], m["dim_nutrients"], ordered=False)
    plan = rep._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"PartitionFilters: \[isnotnull\(logged_date#\d+\), \(logged_date#\d+ = Subquery", plan), plan
    lazy = R.latest_segments_report(Warehouse.from_testdata(spark, SF_SMALL, "events").fct_user_segments,
                                    w.dim_nutrients, ordered=False)
    assert rows(rep) == rows(lazy)


def test_reprocess_dates_recovers_late_rows(spark, scratch):
    import datetime as dt
    from platewise import schemas
    base = Warehouse.from_testdata(spark, SF_SMALL, "events")
    logs = base.raw_meal_logs
    late_day = "2024-01-05"
    extra = spark.createDataFrame([(7, [(1, 100.0)], None, None, dt.datetime(2024, 1, 5, 12))], schemas.RAW_MEAL_LOGS)
    path = f"{scratch}/m"
    sel = ["fct_meal_logs"]
    build_marts(base, path, "2024-01-31 06:00:00", select=sel)
    with_late = Warehouse.from_testdata(spark, SF_SMALL, "events", raw_meal_logs=logs.unionByName(extra))
    build_marts(with_late, path, "2024-02-01 06:00:00", select=sel)                 # reference mode: dropped
    has_late = "user_id = 7 AND fdc_id = 1 AND logged_date = date'2024-01-05' AND grams = 100.0"
    assert spark.read.parquet(f"{path}/fct_meal_logs").where(has_late).count() == 0
    with_late = Warehouse.from_testdata(spark, SF_SMALL, "events", raw_meal_logs=logs.unionByName(extra))
    build_marts(with_late, path, "2024-02-01 07:00:00", select=sel, reprocess_dates=[late_day])
    got = spark.read.parquet(f"{path}/fct_meal_logs")
    assert got.where(has_late).count() == 1
    full = Warehouse.from_testdata(spark, SF_SMALL, "events", raw_meal_logs=logs.unionByName(extra)).fct_meal_logs
    assert rows(got.select(*full.columns)) == rows(full)


def test_daily_build_computes_only_what_is_new(spark, scratch):
    full = Warehouse.from_testdata(spark, SF_SMALL, "events")
    root = f"{scratch}/m"
    cut = F.date_add(full.feed_span()[0], 14)
    first = Warehouse.from_testdata(spark, SF_SMALL, "events", raw_meal_logs=full.raw_meal_logs.where(F.to_date("logged_at") <= cut),
                                    feed_dates=full.feed_dates.where(F.col("day") <= cut))
    build_marts(first, root, "2024-01-15 06:00:00", select=["fct_meal_logs", "fct_user_segments"])
    from platewise.plans.jobs import lowest_mark
    mark = lowest_mark(spark, root, ["fct_meal_logs", "fct_user_segments"])
    new = full.after(mark)
    days = {r[0] for r in new.items.select("logged_date").distinct().collect()}
    held = spark.read.parquet(f"{root}/fct_meal_logs").agg(F.max("logged_date")).first()[0]
    assert days and min(days) > held
    assert lowest_mark(spark, root, ["fct_meal_logs", "fct_meal_log_nutrients"]) is None  # one has to be built first


def test_windowed_mart_reads_the_accumulated_fact(spark, scratch):
    full = Warehouse.from_testdata(spark, SF_SMALL, "events")
    root, sel = f"{scratch}/m", ["fct_meal_log_nutrients", "fct_user_segments_windowed"]
    build_marts(full, root, "2024-01-31 06:00:00", select=sel)
    want = rows(read_marts(spark, root)["fct_user_segments_windowed"])
    last = full.feed_span()[1]
    daily = Warehouse.from_testdata(spark, SF_SMALL, "events", raw_meal_logs=full.raw_meal_logs.where(F.to_date("logged_at") == last),
                                    feed_dates=full.feed_dates.where(F.col("day") == last))
    build_marts(daily, root, "2024-01-31 07:00:00", select=sel)
    assert rows(read_marts(spark, root)["fct_user_segments_windowed"]) == want


def test_reprocessing_clears_days_that_became_empty(spark, scratch):
    full = Warehouse.from_testdata(spark, SF_SMALL, "events")
    path, sel = f"{scratch}/m", ["fct_meal_logs"]
    build_marts(full, path, "2024-01-31 06:00:00", select=sel)
    gone = Warehouse.from_testdata(spark, SF_SMALL, "events", raw_meal_logs=full.raw_meal_logs.where("to_date(logged_at) <> '2024-01-05'"))
    build_marts(gone, path, "2024-01-31 07:00:00", select=sel, reprocess_dates=["2024-01-05"])
    got = spark.read.parquet(f"{path}/fct_meal_logs")
    assert rows(got.select(*full.fct_meal_logs.columns)) == rows(full.fct_meal_logs.where("logged_date <> '2024-01-05'"))


def test_two_loads_of_a_food_leave_one_open_version(spark, scratch):
    from platewise.plans.catalog import _two_loads
    root, sel = f"{scratch}/m", ["dim_foods_snapshot"]
    build_marts(Warehouse.from_testdata(spark, SF_SMALL, "events"), root, "2024-02-02 00:00:00", select=sel)
    build_marts(Warehouse.from_testdata(spark, SF_SMALL, "events", raw_foods=_two_loads(spark, SF_SMALL)), root,
                "2024-03-02 00:00:00", select=sel)
    snap = read_marts(spark, root)["dim_foods_snapshot"].where("dbt_valid_to IS NULL")
    assert snap.groupBy("fdc_id").count().where("count > 1").count() == 0
