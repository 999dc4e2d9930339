"""Exact gram amounts: products, sums, rounding, and doubles that no decimal holds."""

import math
import random
from decimal import ROUND_HALF_UP, Decimal, getcontext

import pytest
from pyspark.sql import functions as F

from platewise.functions import grams as G
from platewise.operators import transforms as T

getcontext().prec = 60
N = T.NUTRIENTS
FOODS = "fdc_id long, " + ", ".join(f"{n} decimal(20,10)" for n in N)
ITEMS = "user_id long, meal_id int, fdc_id long, grams double, logged_date date, logged_date_id int"


def scaled(spark, amounts, servings):
    foods = spark.createDataFrame([(k, *map(Decimal, a)) for k, a in enumerate(amounts)], FOODS)
    rows = [(u, 1, k, g, None, None) for u, k, g in servings]
    return T.scaled_exact(spark.createDataFrame(rows, ITEMS), foods)


AMOUNTS = [("13.7", "0", "100", "0.00004", "-2.5"), ("13.70004", "2500000", "0.0000000001", "9999999.9999999999", "1"),
           ("10", "1", "2", "3", "4")]
SERVINGS = [95.0, 80.12345678, 2e9, 1e-9, 0.1, 0.30000000000000004, 82.5, 0.0, -12.25, 1234567.875, 8.9e6, 9.1e6, 99999999.5]


def test_sums_equal_exact_decimals_however_they_are_split(spark):
    rng = random.Random(1)
    rows = [(rng.randint(0, 3), rng.randrange(3), rng.choice(SERVINGS)) for _ in range(600)]
    want = {}
    for u, k, g in rows:
        for n, a in zip(N, AMOUNTS[k]):
            exact = Decimal(a) / 100 * round(Decimal(repr(g)), 12)
            want[u, n] = want.get((u, n), 0) + exact.quantize(Decimal("1e-18"), ROUND_HALF_UP)
    for parts in (1, 7):
        s = scaled(spark, AMOUNTS, rows).repartition(parts)
        sums = T.grouped_grams(s, ["user_id"])
        got = {(r.user_id, n): r[n] for r in G.as_decimals(sums).collect() for n in N}
        assert got == want
        doubles = sums.select("user_id", *[G.to_double(n).alias(n) for n in N]).collect()
        assert {(r.user_id, n): r[n] for r in doubles for n in N} == {k: float(v) for k, v in want.items()}
        cents = sums.select("user_id", *[G.round2(n).alias(n) for n in N]).collect()
        assert {(r.user_id, n): r[n] for r in cents for n in N} == {
            k: float(v.quantize(Decimal("0.01"), ROUND_HALF_UP)) for k, v in want.items()}


def test_common_amounts_are_long_integers(spark):
    s = scaled(spark, AMOUNTS, [(1, 0, 95.0), (1, 2, 82.5), (1, 2, 80.12345678)]).select(F.col(N[0]).alias("p")).collect()
    assert [r.p.d for r in s[:2]] == [None, None] and s[0].p.v == 13_015_000_000_000
    assert s[2].p.d == Decimal("8.012345678") and s[2].p.v is None


@pytest.mark.parametrize("serving,check", [(float("nan"), math.isnan), (float("inf"), math.isinf), (1e300, lambda x: x == 1.37e299),
                                           (2e15, lambda x: abs(x / 2.74e14 - 1) < 1e-12)])
def test_any_double_is_a_valid_serving(spark, serving, check):
    s = T.grouped_grams(scaled(spark, AMOUNTS, [(1, 0, serving), (1, 0, 95.0)]), ["user_id"])
    total = s.select(G.to_double(N[0]).alias("x")).first().x
    assert check(total) or total == serving * 13.7 / 100 + 13.015
    assert G.as_decimals(s).first()[N[0]] is None


def test_limbs_do_not_overflow(spark):
    """A hundred million grams a thousand times: past one long integer."""
    s = scaled(spark, [("100", "99.5", "1", "0", "0")], [(1, 0, 8.5e6)] * 1200 + [(2, 0, 8.5e6), (3, 0, None)])
    got = {r.user_id: r for r in G.as_decimals(T.grouped_grams(s, ["user_id"])).collect()}
    assert got[1][N[0]] == Decimal("10200000000") and got[1][N[1]] == Decimal("10149000000") and got[2][N[0]] == Decimal("8500000")
    assert got[3][N[0]] is None


def test_running_sums(spark):
    from pyspark.sql import Window
    values = [0.1, 80.12345678, 2e9, 7.0]
    d = spark.createDataFrame(list(enumerate(values)), "k int, g double").withColumn("a", G.amount("g"))
    w = Window.partitionBy(F.lit(1)).orderBy("k").rowsBetween(-1, 0)
    got = [r.s for r in d.select("k", G.to_decimal(G.running("a", w)).alias("s")).orderBy("k").collect()]
    exact = [Decimal(repr(v)) for v in values]
    assert got == [exact[0]] + [a + b for a, b in zip(exact, exact[1:])]
