"""Streaming daily intake equals the batch answer, whatever the order of files."""

import datetime as dt
from decimal import Decimal

from platewise import schemas
from platewise.streaming.meal_stream import compact, late_rows, read_daily, run_daily_intake_stream

TS = dt.datetime


def foods(spark):
    return spark.createDataFrame([(10, Decimal("10"), Decimal("0"), Decimal("0"), Decimal("0"), Decimal("0"))],
                                 "fdc_id long, protein_g decimal(20,10), fat_g decimal(20,10), "
                                 "carbohydrate_g decimal(20,10), fiber_g decimal(20,10), total_sugar_g decimal(20,10)")


def land(spark, path, rows):
    spark.createDataFrame(rows, schemas.RAW_MEAL_LOGS).coalesce(1).write.mode("append").parquet(path)


def protein(spark, sink):
    return {(r.user_id, r.logged_date): float(r.daily_value_g) for r in read_daily(spark, sink).where("nutrient_id = 1").collect()}


def test_files_in_any_order_are_complete(spark, scratch):
    landing, sink, ckpt = f"{scratch}/landing", f"{scratch}/daily", f"{scratch}/_ckpt"

    def run(**kw):
        run_daily_intake_stream(spark, landing, foods(spark), sink, ckpt, **kw)

    land(spark, landing, [(1, [(10, 10.0)], None, None, TS(2024, 1, 26, 8))])
    run(max_files_per_trigger=1)
    land(spark, landing, [(1, [(10, 100.0)], None, None, TS(2024, 1, 1, 8))])
    land(spark, landing, [(1, None, [(10, 50.0)], None, TS(2024, 1, 1, 13)), (2, [(10, 200.0)], [], None, TS(2024, 1, 2, 8))])
    run(max_files_per_trigger=1)
    want = {(1, dt.date(2024, 1, 1)): 15.0, (2, dt.date(2024, 1, 2)): 20.0, (1, dt.date(2024, 1, 26)): 1.0}
    assert protein(spark, sink) == want
    # weeks late: still added to its day, and counted
    land(spark, landing, [(1, [(10, 100.0)], None, None, TS(2024, 1, 1, 9)), (3, [(10, 30.0)], None, None, TS(2024, 1, 27, 9))])
    run()
    want |= {(1, dt.date(2024, 1, 1)): 25.0, (3, dt.date(2024, 1, 27)): 3.0}
    assert protein(spark, sink) == want
    assert sum(r.late for r in late_rows(spark, sink).collect()) == 4
    run()  # nothing new: the sink is unchanged
    assert protein(spark, sink) == want
    compact(spark, sink)
    assert protein(spark, sink) == want and spark.read.parquet(sink).select("batch_id").distinct().count() == 1


def test_replayed_batch_overwrites_its_own_rows(spark, scratch):
    from platewise.operators import transforms as T
    from platewise.streaming import meal_stream as X
    items = spark.createDataFrame([(1, 1, 10, 100.0, dt.date(2024, 1, 1), 20240101)],
                                  "user_id long, meal_id int, fdc_id long, grams double, logged_date date, logged_date_id int")
    scaled, sink = T.scaled_nutrients(items, foods(spark)), f"{scratch}/daily"
    for batch_id in (0, 1, 1, 0):
        X._write_sums(sink)(scaled, batch_id)
    assert protein(spark, sink) == {(1, dt.date(2024, 1, 1)): 20.0}
