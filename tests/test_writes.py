"""Write patterns: incremental = full refresh, late data, key merge, SCD2, landing."""

import datetime as dt
import json

from pyspark.sql import functions as F

from platewise.operators import writes as W

D = dt.date
SCHEMA = "user_id long, meal_id int, fdc_id long, grams double, logged_date date, logged_date_id int"
KEY = ["user_id", "meal_id", "fdc_id", "logged_date"]


def items(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def rows_of(df):
    return sorted(tuple(r[c] for c in ["user_id", "meal_id", "fdc_id", "grams", "logged_date"]) for r in df.collect())


def day(n):
    return D(2024, 1, n)


def test_incremental_day_by_day_equals_full_refresh(spark, scratch):
    allrows = [(u, 1, 10 + u, 100.0 + n, day(n), 20240100 + n) for n in range(1, 8) for u in (1, 2)]
    full = items(spark, allrows)
    path = f"{scratch}/fct"
    for n in range(1, 8):
        W.incremental_append(full.where(F.col("logged_date") <= F.lit(day(n))), path, "logged_date", ["logged_date"])
    assert rows_of(spark.read.parquet(path)) == rows_of(full)


def test_late_rows_are_dropped_in_reference_mode(spark, scratch):
    path = f"{scratch}/fct"
    W.incremental_append(items(spark, [(1, 1, 10, 100.0, day(5), 20240105)]), path, "logged_date", ["logged_date"])
    late = items(spark, [(1, 2, 11, 50.0, day(5), 20240105), (1, 1, 12, 60.0, day(3), 20240103),
                         (1, 1, 13, 70.0, day(6), 20240106)])
    W.incremental_append(late, path, "logged_date", ["logged_date"])
    assert [r[2] for r in rows_of(spark.read.parquet(path))] == [10, 13]


def test_an_empty_target_gets_the_whole_batch(spark, scratch):
    path = f"{scratch}/fct"
    row = items(spark, [(1, 1, 10, 100.0, day(5), 20240105)])
    for df in (row.limit(0), row, row):
        W.incremental_append(df, path, "logged_date")
    assert rows_of(spark.read.parquet(path)) == rows_of(row)


def test_merge_by_key_replaces_only_touched_partitions(spark, scratch):
    path = f"{scratch}/fct"
    base = items(spark, [(1, 1, 10, 100.0, day(1), 20240101), (1, 1, 10, 100.0, day(2), 20240102),
                         (2, 1, 10, 100.0, day(2), 20240102)])
    W.merge_by_key(base, path, KEY, ["logged_date"])
    fix = items(spark, [(1, 1, 10, 150.0, day(2), 20240102), (1, 1, 10, 151.0, day(2), 20240102),
                        (3, 1, 10, 90.0, day(3), 20240103)])
    W.merge_by_key(fix, path, KEY, ["logged_date"])
    got = rows_of(spark.read.parquet(path))
    assert got == [(1, 1, 10, 100.0, day(1)), (1, 1, 10, 150.0, day(2)), (1, 1, 10, 151.0, day(2)),
                   (2, 1, 10, 100.0, day(2)), (3, 1, 10, 90.0, day(3))]


def foods(spark, rows):
    return spark.createDataFrame(rows, "fdc_id long, description string, protein_g double, fat_g double")


def test_scd2_check_snapshot_and_point_in_time(spark, scratch):
    path = f"{scratch}/snap"
    W.snapshot_check(foods(spark, [(1, "a", 1.0, 1.0), (2, "b", 2.0, None), (3, "c", 3.0, 3.0)]), path,
                     "fdc_id", ["protein_g", "fat_g"], "2024-02-01 00:00:00")
    # 1 unchanged (description change is not tracked), 2 NULL -> value, 3 deleted, 4 new
    W.snapshot_check(foods(spark, [(1, "a2", 1.0, 1.0), (2, "b", 2.0, 5.0), (4, "d", 4.0, 4.0)]), path,
                     "fdc_id", ["protein_g", "fat_g"], "2024-03-01 00:00:00")
    snap = W.read_snapshot(spark, path)
    t1, t2 = dt.datetime(2024, 2, 1), dt.datetime(2024, 3, 1)
    got = sorted(((r.fdc_id, r.description, r.fat_g, r.dbt_valid_from, r.dbt_valid_to) for r in snap.collect()),
                 key=lambda t: (t[0], t[3]))
    assert got == [(1, "a", 1.0, t1, None), (2, "b", None, t1, t2), (2, "b", 5.0, t2, None),
                   (3, "c", 3.0, t1, None), (4, "d", 4.0, t2, None)]
    # intervals of one key never overlap
    for k in (1, 2, 3, 4):
        iv = sorted((r.dbt_valid_from, r.dbt_valid_to or dt.datetime.max) for r in snap.where(f"fdc_id={k}").collect())
        assert all(a[1] <= b[0] for a, b in zip(iv, iv[1:]))
    before = {r.fdc_id: r.fat_g for r in W.as_of(snap, "2024-02-15 00:00:00").collect()}
    assert before == {1: 1.0, 2: None, 3: 3.0}
    at = {r.fdc_id: r.fat_g for r in W.as_of(snap, "2024-03-01 00:00:00").collect()}
    assert at == {1: 1.0, 2: 5.0, 3: 3.0, 4: 4.0}


def test_land_food_pages_from_files(spark, scratch):
    pages = [[{"fdcId": 1, "description": "x", "foodNutrients": []}, {"fdcId": 2}], [{"fdcId": 3, "a": [1, 2]}]]
    for i, p in enumerate(pages):
        with open(f"{scratch}/page_{i}.json", "w") as f:
            json.dump(p, f)
    landed = W.land_food_pages(W.read_food_pages(spark, f"{scratch}/page_*.json"), "2024-02-01 00:00:00")
    got = sorted((r.fdc_id, json.loads(r.raw_json)) for r in landed.collect())
    assert [g[0] for g in got] == [1, 2, 3]
    assert got[2][1] == {"fdcId": 3, "a": [1, 2]}                  # stored as received
    W.append_table(landed, f"{scratch}/raw_foods")
    W.append_table(landed, f"{scratch}/raw_foods")                  # append-only: not idempotent
    assert spark.read.parquet(f"{scratch}/raw_foods").count() == 6


def test_full_refresh_leaves_no_stale_partition(spark, scratch):
    path = f"{scratch}/fct"
    before = spark.conf.get("spark.sql.sources.partitionOverwriteMode")
    spark.conf.set("spark.sql.sources.partitionOverwriteMode", "dynamic")
    try:
        W.replace_table(items(spark, [(1, 1, 10, 1.0, day(n), 20240100 + n) for n in (1, 2, 3)]), path, ["logged_date"])
        W.replace_table(items(spark, [(1, 1, 10, 2.0, day(2), 20240102)]), path, ["logged_date"])
    finally:
        spark.conf.set("spark.sql.sources.partitionOverwriteMode", before)
    assert rows_of(spark.read.parquet(path)) == [(1, 1, 10, 2.0, day(2))]


def test_merge_reads_only_the_partitions_it_may_touch(spark, scratch):
    import re
    path = f"{scratch}/fct"
    W.replace_table(items(spark, [(1, 1, 10, 1.0, day(n), 20240100 + n) for n in range(1, 9)]), path, ["logged_date"])
    batch = items(spark, [(1, 1, 10, 5.0, day(4), 20240104)])
    plan = W.touched_partitions(spark.read.parquet(path), batch, ["logged_date"])._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"PartitionFilters: \[[^\]]*logged_date#\d+ >= [^\]]*ubquery", plan), plan


def test_replace_partitions_clears_emptied_days(spark, scratch):
    path = f"{scratch}/fct"
    W.replace_table(items(spark, [(1, 1, 10, 1.0, day(n), 20240100 + n) for n in (1, 2, 3)]), path, ["logged_date"])
    new = items(spark, [(1, 1, 10, 9.0, day(2), 20240102)])
    W.replace_partitions(new, path, ["logged_date"], ["2024-01-02", "2024-01-03"])
    assert rows_of(spark.read.parquet(path)) == [(1, 1, 10, 1.0, day(1)), (1, 1, 10, 9.0, day(2))]
    W.replace_partitions(new.limit(0), path, ["logged_date"], ["2024-01-02"])
    assert rows_of(spark.read.parquet(path)) == [(1, 1, 10, 1.0, day(1))]


def test_staged_copies_go_after_a_good_write_and_stay_after_a_failure(spark, scratch):
    import os
    path = f"{scratch}/fct"
    for _ in range(2):
        W.merge_by_key(items(spark, [(1, 1, 10, 1.0, day(1), 20240101)]), path, KEY, ["logged_date"])
    assert os.listdir(f"{path}__staging") == []
    try:
        with W.staged(items(spark, [(1, 1, 10, 1.0, day(1), 20240101)]), path):
            raise OSError("the final copy fails")
    except OSError:
        pass
    assert len(os.listdir(f"{path}__staging")) == 1


def test_snapshot_keeps_closed_rows_in_place_and_can_be_repeated(spark, scratch):
    import os
    path = f"{scratch}/snap"
    runs = [("2024-02-01 00:00:00", 1.0), ("2024-03-01 00:00:00", 2.0), ("2024-04-01 00:00:00", 3.0)]
    seen = {}
    for at, v in runs:
        W.snapshot_check(foods(spark, [(1, "a", v, 1.0), (2, "b", 2.0, 2.0)]), path, "fdc_id", ["protein_g", "fat_g"], at)
        closed = {f"{d}/{f}": os.path.getmtime(f"{path}/{d}/{f}") for d in os.listdir(path)
                  if d.startswith(W.SCD_PART) and not d.endswith(W.OPEN) for f in os.listdir(f"{path}/{d}")}
        assert seen.items() <= closed.items()
        seen = closed
    first = sorted(map(str, W.read_snapshot(spark, path).collect()))
    assert len(first) == 4 and W.read_snapshot(spark, path).where("dbt_valid_to IS NULL").count() == 2
    W.snapshot_check(foods(spark, [(1, "a", 3.0, 1.0), (2, "b", 2.0, 2.0)]), path, "fdc_id", ["protein_g", "fat_g"], runs[-1][0])
    assert sorted(map(str, W.read_snapshot(spark, path).collect())) == first


def test_snapshot_refuses_repeated_keys(spark, scratch):
    import pytest
    with pytest.raises(ValueError, match="one row per key"):
        W.snapshot_check(foods(spark, [(1, "a", 1.0, 1.0), (1, "b", 2.0, 2.0)]), f"{scratch}/snap", "fdc_id", ["protein_g"],
                         "2024-02-01 00:00:00")


def test_scd_key_is_the_public_macros_hash(spark):
    import hashlib
    got = spark.createDataFrame([(7, "2024-02-01 00:00:00"), (None, "2024-02-01 00:00:00")], "k int, t string").select(
        W.snapshot_key(F.col("k"), F.col("t").cast("timestamp_ntz")).alias("h")).collect()
    assert [r.h for r in got] == [hashlib.md5(x.encode()).hexdigest() for x in ("7|2024-02-01 00:00:00", "|2024-02-01 00:00:00")]
