"""Late, corrected and deleted rows are found by day sums, and only their days are read and rebuilt."""

import datetime as dt
import os
import re

from paths import SF_SMALL
from pyspark.sql import functions as F

from platewise import schemas
from platewise.operators import late as L
from platewise.plans.build import Warehouse
from platewise.plans.jobs import build_changed_days


def rows(df):
    return sorted(map(repr, df.select(*sorted(df.columns)).collect()))


def test_only_changed_days_are_rebuilt(spark, scratch):
    w = Warehouse.from_testdata(spark, SF_SMALL, "events")
    raw, marts, sel = f"{scratch}/raw", f"{scratch}/marts", ["fct_meal_logs", "fct_user_segments"]
    L.land_load(w.raw_meal_logs, raw, "1")
    every = build_changed_days(w, raw, marts, "2024-01-31 06:00:00", sel)
    assert len(every) == 30 and build_changed_days(w, raw, marts, "2024-01-31 07:00:00", sel) == []
    files = lambda: {f"{d}/{f}": os.path.getmtime(f"{d}/{f}") for d, _, fs in os.walk(f"{marts}/fct_meal_logs")
                     for f in fs if f.endswith(".parquet")}
    before = files()
    extra = spark.createDataFrame([(7, [(1, 100.0)], None, None, dt.datetime(2024, 1, 5, 12)),
                                   (8, [(2, 50.0), (3, 60.0)], [], [], dt.datetime(2024, 1, 9, 1))], schemas.RAW_MEAL_LOGS)
    L.land_load(extra, raw, "2")
    assert build_changed_days(w, raw, marts, "2024-02-01 06:00:00", sel) == ["2024-01-05", "2024-01-09"]
    changed = set(files().items()) ^ set(before.items())
    assert {re.search(r"logged_date=([\d-]+)", p)[1] for p, _ in changed} == {"2024-01-05", "2024-01-09"}
    full = Warehouse.from_testdata(spark, SF_SMALL, "events", raw_meal_logs=w.raw_meal_logs.unionByName(extra))
    for name in sel:
        got = spark.read.parquet(f"{marts}/{name}")
        assert rows(got.select(*getattr(full, name).columns)) == rows(getattr(full, name)), name
    # the late load comes again without its first record: a correction, and a day back to what it was
    L.land_load(extra.where("user_id = 8"), raw, "2")
    assert build_changed_days(w, raw, marts, "2024-02-02 06:00:00", sel) == ["2024-01-05"]


def test_other_days_are_not_read(spark, scratch):
    w = Warehouse.from_testdata(spark, SF_SMALL, "events")
    L.land_load(w.raw_meal_logs, f"{scratch}/raw", "1")
    plan = L.read_logs(spark, f"{scratch}/raw", ["2024-01-05"])._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"PartitionFilters: \[[^\]]*day#\d+ = 2024-01-05|PartitionFilters: \[[^\]]*day#\d+ = 19727", plan), plan
    files = [r[0] for r in L.read_logs(spark, f"{scratch}/raw", ["2024-01-05"]).select(F.input_file_name()).distinct().collect()]
    assert files and all("day=2024-01-05" in f for f in files)


def test_an_unfinished_load_does_not_count(spark, scratch):
    logs = Warehouse.from_testdata(spark, SF_SMALL, "events").raw_meal_logs
    L.land_load(logs, f"{scratch}/raw", "1")
    logs.withColumn("day", logs.logged_at.cast("date")).write.partitionBy("day").parquet(f"{scratch}/raw/logs/load=2")
    assert L.read_logs(spark, f"{scratch}/raw").count() == logs.count()


def test_sums_tell_any_two_days_apart(spark):
    make = lambda *v: L.day_sums(spark.createDataFrame([(dt.date(2024, 1, 1), x) for x in v], "day date, x int"))
    a = make(1, 2, 2, 3)
    assert L.changed_days(a, make(2, 3, 1, 2)) == []
    for other in (make(1, 2, 3), make(1, 2, 2, 3, 3), make(1, 1, 2, 3), make(1, 2, 2, 4)):
        assert L.changed_days(a, other) == ["2024-01-01"]
