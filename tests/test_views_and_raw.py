"""Raw tables, key scan, loads, and SQL over the registered model views."""

import datetime as dt

from paths import SF_SMALL
from platewise import schemas
from platewise.plans import reports as R
from platewise.plans.build import Warehouse
from platewise.sources import raw


def test_create_raw_tables_is_idempotent(spark, scratch):
    paths = raw.create_raw_tables(spark, scratch)
    ts = dt.datetime(2024, 1, 1, 12)
    raw.load_historic_meal_logs(spark.createDataFrame([(1, None, [(1, 1.0)], None, ts)], schemas.RAW_MEAL_LOGS),
                                paths["raw_meal_logs"])
    raw.create_raw_tables(spark, scratch)                       # existing data untouched
    assert raw.read_raw(spark, paths["raw_meal_logs"], "raw_meal_logs").count() == 1
    raw.load_daily_meal_logs(spark.createDataFrame([(2, [], [], [(3, 2.0)], ts), (3, None, None, [(4, 1.0)], ts)],
                                                    schemas.RAW_MEAL_LOGS), paths["raw_meal_logs"])
    assert sorted(r.user_id for r in raw.read_raw(spark, paths["raw_meal_logs"], "raw_meal_logs").collect()) == [2, 3]


def test_sql_over_registered_views(spark):
    w = Warehouse.from_testdata(spark, SF_SMALL, "events")
    names = w.register_views(prefix="pw_")
    assert "pw_fct_meal_log_nutrients" in names and "pw_stg_meal_logs" in names
    by_sql = spark.sql("""
        SELECT f.user_id, n.nutrient_name, f.logged_date, CAST(SUM(f.value_g) AS DOUBLE) AS daily_value_g
        FROM pw_fct_meal_log_nutrients f JOIN pw_dim_nutrients n ON f.nutrient_id = n.nutrient_id
        GROUP BY f.user_id, n.nutrient_name, f.logged_date""")
    by_api = R.daily_intake_report(w.fct_meal_log_nutrients, w.dim_nutrients, ordered=False)
    assert sorted(map(tuple, by_sql.collect())) == sorted(map(tuple, by_api.collect()))
