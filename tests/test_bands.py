"""The band join against all pairs, and its plan."""

import math
import random
from decimal import Decimal

from pyspark.sql import functions as F

from platewise.operators import bands as B
from platewise.operators.bands import band_join
from platewise.plans import catalog
from paths import SF_SMALL


def check(spark, values, bands, vtype="double", btype="double"):
    v = spark.createDataFrame(list(enumerate(values)), f"id int, v {vtype}")
    b = spark.createDataFrame([(k, *x) for k, x in enumerate(bands)], f"band int, lo {btype}, hi {btype}")
    got = sorted((r.id, r.band) for r in band_join(v, "v", b, "lo", "hi").select("id", "band").collect())
    want = sorted((i, k) for i, x in enumerate(values) if x is not None and x == x
                  for k, (lo, hi) in enumerate(bands) if (lo is None or x >= lo) and (hi is None or x < hi))
    assert got == want


def test_all_kinds_of_bands(spark):
    rng = random.Random(3)
    ends = [0.0, 18.5, 25.0, 30.0, -1e-9, 1e-9, 1e300, -1e300, math.inf, -math.inf, 5e-324, 2.0 ** 60]
    bands = [(0.0, 18.5), (18.5, 25.0), (25.0, 30.0), (30.0, 999.0), (7.0, 7.0), (9.0, 8.0), (None, 3.0), (120.0, None), (None, None)]
    bands += [tuple(sorted((rng.choice(ends), rng.choice(ends)))) for _ in range(30)]
    bands += [(x, x + rng.choice([1e-6, 0.125, 0.1, 3.0, 64.0, 1000.0])) for x in (rng.uniform(-200, 200) for _ in range(200))]
    values = ends + [None, math.nan, 18.499999999999996, 29.999999999999996, 120.0] + [rng.uniform(-250, 250) for _ in range(150)]
    check(spark, values, bands)


def test_exact_ends_of_decimals_and_whole_numbers(spark):
    d = [Decimal(k) / 10 ** 20 for k in range(12)]
    check(spark, d, [(d[i], d[j]) for i in range(0, 12, 3) for j in range(12)], "decimal(38,20)", "decimal(38,20)")
    big = (1 << 53) + 1
    check(spark, list(range(big - 3, big + 6)), [(big, big + 2), (big - 1, big), (None, big + 1)], "long", "long")


def test_empty_sides(spark):
    check(spark, [], [(1.0, 2.0)])
    check(spark, [1.5], [])


def test_no_nested_loop(spark):
    for key in ("j3_weight_bands", "c5_user_bmi"):
        plan = catalog.QUERIES[key](spark, SF_SMALL)._jdf.queryExecution().executedPlan().toString()
        assert "NestedLoop" not in plan and "Cartesian" not in plan


def extremes(spark, values, bands):
    v = spark.createDataFrame([(x,) for x in values], "v double").repartition(5)
    b = spark.createDataFrame(bands, "band int, lo double, hi double")
    want = {}
    for k, lo, hi in bands:
        held = [x for x in values if x is not None and x == x and (lo is None or x >= lo) and (hi is None or x < hi)]
        want.setdefault(k, []).extend(held)
    got = {r[0]: tuple(r)[1:] for r in B.band_extremes(v, "v", b, "band", "lo", "hi").collect()}
    assert got == {k: (len(x), min(x), max(x)) for k, x in want.items() if x}


def test_extremes_are_those_of_all_pairs(spark):
    rng = random.Random(4)
    odd = [0.0, 18.5, 25.0, -1e-9, 1e300, -1e300, 5e-324, 2.0 ** 60, math.inf, -math.inf]
    values = [None, math.nan, *odd, *odd, *[rng.choice([rng.uniform(-50, 50), float(rng.randrange(9))]) for _ in range(300)]]
    ends = [*odd, None, 7.0, 8.0, math.nan, *[rng.uniform(-60, 60) for _ in range(20)]]
    bands = [(rng.choice([None, *range(90)]), rng.choice(ends), rng.choice(ends)) for _ in range(300)]  # keys repeat
    extremes(spark, values, bands)
    extremes(spark, [x for x in values if x is not None and abs(x) < 40], bands)
    extremes(spark, [7.0], bands)
    extremes(spark, [None, math.nan], bands)
    extremes(spark, values, [])


def test_wide_bands_are_not_listed_pair_by_pair(spark, monkeypatch):
    rows = []
    join = B.band_join

    def counted(*a):
        out = join(*a)
        rows.append(out.count())
        return out

    monkeypatch.setattr(B, "band_join", counted)
    monkeypatch.setattr(catalog, "band_join", counted, raising=False)
    n = catalog.QUERIES["j3_weight_bands"](spark, SF_SMALL).agg(F.sum("weigh_ins")).collect()[0][0]
    parts = spark.read.parquet(f"{SF_SMALL}/part.parquet").count()
    assert sum(rows) <= 2 * parts and n > 0
    v, b = spark.range(1000).select(F.col("id").cast("double").alias("v")), spark.range(500).select("id", F.lit(0.5).alias("lo"), F.lit(999.0).alias("hi"))
    rows.clear()
    assert {tuple(r)[1:] for r in B.band_extremes(v, "v", b, "id", "lo", "hi").collect()} == {(998, 1.0, 998.0)}
    assert sum(rows) <= 1000
