"""Property checks: exact scaling and summing equals Decimal arithmetic, for small and very large amounts."""

import datetime as dt
from collections import defaultdict
from decimal import ROUND_HALF_UP, Decimal

from hypothesis import given, settings
from hypothesis import strategies as st

from platewise.operators import transforms as T

FOODS = "fdc_id long, protein_g decimal(20,10), fat_g decimal(20,10), carbohydrate_g decimal(20,10), " \
        "fiber_g decimal(20,10), total_sugar_g decimal(20,10)"
ITEMS = "user_id long, meal_id int, fdc_id long, grams double, logged_date date, logged_date_id int"

amount = st.one_of(st.decimals(min_value=0, max_value=100, places=10, allow_nan=False, allow_infinity=False),
                   st.decimals(min_value=10**8, max_value=9 * 10**9, places=6, allow_nan=False, allow_infinity=False))
grams = st.decimals(min_value=0, max_value=1000, places=4, allow_nan=False, allow_infinity=False)
item = st.tuples(st.integers(1, 3), st.integers(1, 3), st.integers(1, 4), grams, st.integers(1, 3))


@settings(max_examples=15, deadline=None)
@given(st.lists(st.tuples(amount, amount), min_size=4, max_size=4), st.lists(item, min_size=1, max_size=25))
def test_daily_totals_are_exact(spark, food_vals, items):
    foods = spark.createDataFrame([(i + 1, p, f, Decimal(0), Decimal(0), Decimal(0))
                                   for i, (p, f) in enumerate(food_vals)], FOODS)
    rows = [(u, m, fid, float(g), dt.date(2024, 1, d), 20240100 + d) for u, m, fid, g, d in items]
    got = {(r.user_id, r.nutrient_id, r.logged_date): r.daily_value_g
           for r in T.daily_totals(T.scaled_nutrients(spark.createDataFrame(rows, ITEMS), foods)).collect()}
    want = defaultdict(Decimal)
    for u, m, fid, g, d in items:
        p, f = food_vals[fid - 1]
        want[(u, 1, dt.date(2024, 1, d))] += p * g / 100
        want[(u, 2, dt.date(2024, 1, d))] += f * g / 100
    for k, v in want.items():
        assert got[k] == v, (k, got[k], v)
        r = T.round_exact  # rounding to cents happens on the exact value
        assert v.quantize(Decimal("0.01"), rounding=ROUND_HALF_UP) == spark.range(1).select(
            r(T.F.lit(got[k]), 2).alias("x")).first().x
