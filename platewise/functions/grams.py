"""Exact gram amounts as whole numbers of 10^-12 g, so that sums stay off the 38-digit decimal path.

A gram amount is a struct of three parts, of which exactly one is set (all are NULL for an unknown amount):

``v``  BIGINT, units of 10^-12 g: amounts under 9 million g without digits beyond the twelfth, nearly all there are;
``d``  DECIMAL(38,18): other amounts under 10^16 g, of servings under 10^15 g (a group's sum must stay under 10^19 g);
``x``  DOUBLE: what is beyond (more than that, infinity, not a number). A sum that holds one may hold ``v`` or ``d`` beside
       it.

``total`` adds ``v`` in two limbs, the upper bits and the lower 30 bits, each a plain BIGINT sum that up to 2^32 rows
cannot overflow, and folds the carry once per group; decimals are only touched by rows that have one (aggregate
filters). All sums of ``v`` and ``d`` are exact, so results do not depend on the order in which executors add them.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType, StructType

DIGITS = 12
EXACT = DecimalType(38, 18)
_ADDEND = DecimalType(37, 18)  # the sum of two keeps 18 decimals
#: Servings that are not whole numbers count to 12 decimals.
_SERVING = DecimalType(27, 12)
_UNIT = Decimal("0.000000000001")
_LIMB, _LIMB_UNIT = 30, Decimal("0.001073741824")  # 2^30 units
_MASK = (1 << _LIMB) - 1
#: ``v`` stays under 2^63 units.
SMALL_G, LARGE_SERVING_G, LARGE_G = 9.0e6, 1.0e15, 1.0e16


def is_grams(df: DataFrame, column: str) -> bool:
    return isinstance(df.schema[column].dataType, StructType)


def _parts(g: str | Column) -> tuple[Column, Column, Column]:
    g = F.col(g) if isinstance(g, str) else g
    return g["v"], g["d"], g["x"]


def _make(v: Column, d: Column, x: Column) -> Column:
    return F.struct(v.cast("long").alias("v"), d.cast(EXACT).alias("d"), x.cast("double").alias("x"))


def seldom(when: Column, values: Column, form) -> Column:
    """``form`` of each of the ``values`` where ``when`` holds, else NULL. A higher-order function, so that the code of
    rare cases stays out of the compiled code of the common one (methods over 8,000 bytecodes are not compiled)."""
    return F.when(when, F.transform(values, form))


def known(g: str | Column) -> Column:
    v, d, x = _parts(g)
    return v.isNotNull() | d.isNotNull() | x.isNotNull()


# -------------------------------------------------------------------- products
def factors(foods: DataFrame, key: str, nutrients: list[str]) -> DataFrame:
    """Per food, once: each nutrient's units per gram (``_p``), the same in 10^-6 g (``_q``, where all are whole numbers
    of it: ``_coarse``), the exact amounts (``_a``), whether all have units (``_plain``) and the largest (``_most``)."""
    d = foods.selectExpr(key, *nutrients, f"array({', '.join(nutrients)}) AS _a",
                         *[f"try_cast(CAST({n} * CAST(1e10 AS DECIMAL(11, 0)) AS DECIMAL(38, 0)) AS BIGINT) AS _p_{n}" for n in nutrients])
    return d.selectExpr("*", *[f"_p_{n} div 1000000 AS _q_{n}" for n in nutrients],
                        " AND ".join(f"coalesce(_p_{n} % 1000000 = 0, false)" for n in nutrients) + " AS _coarse",
                        " AND ".join(f"(_p_{n} IS NOT NULL OR {n} IS NULL)" for n in nutrients) + " AS _plain",
                        "aggregate(_a, 0D, (most, a) -> greatest(most, abs(CAST(a AS DOUBLE)))) AS _most").drop(*nutrients)


def servings(joined: DataFrame, grams: str, nutrients: list[str]) -> DataFrame:
    """Items beside their food's ``factors`` -> each nutrient's grams. A NULL serving gives unknown amounts."""
    keep = [c for c in joined.columns if not c.startswith("_") and c not in nutrients]
    small = f"_plain AND abs(_g) * _most / 100 < {SMALL_G} AND abs(_g) < {SMALL_G}"
    d = joined.selectExpr("*", f"CAST({grams} AS DOUBLE) AS _g").selectExpr(
        "*", f"CASE WHEN {small} AND _g = floor(_g) THEN CAST(_g AS BIGINT) END AS _w",
        f"CASE WHEN {small} AND _coarse AND round(_g * 1e6D) / 1e6D = _g THEN CAST(round(_g * 1e6D) AS BIGINT) END AS _m",
        f"isnan(_g) OR abs(_g) >= {LARGE_SERVING_G} OR abs(_g) * _most / 100 >= {LARGE_G} AS _wild")
    p, whole = "CAST(a * 0.01 AS DECIMAL(20, 12))", "CAST(floor(CAST(_g AS DECIMAL(27, 12))) AS DECIMAL(15, 0))"
    exact = (f"CAST(CAST({p} * {whole} AS DECIMAL(36, 18)) + CAST({p} * CAST(CAST(_g AS DECIMAL(27, 12)) - {whole} "
             f"AS DECIMAL(12, 12)) AS DECIMAL(27, 18)) AS {EXACT.simpleString()})")
    # higher-order functions keep the code of rare cases out of the compiled code of the common one
    d = d.selectExpr("*", f"CASE WHEN NOT _wild AND _w IS NULL AND _m IS NULL THEN transform(_a, a -> {exact}) END AS _d",
                     "CASE WHEN _wild THEN transform(_a, a -> CAST(a AS DOUBLE) * _g / 100) END AS _x")
    return d.selectExpr(*keep, *[f"named_struct('v', coalesce(_p_{n} * _w, _q_{n} * _m), 'd', get(_d, {k}), 'x', get(_x, {k})) AS {n}"
                                 for k, n in enumerate(nutrients)])


def amount(g: str | Column) -> Column:
    """A DOUBLE number of grams as a gram amount."""
    g = F.col(g) if isinstance(g, str) else g
    micro = F.round(g * 1e6)
    small = F.abs(g) < SMALL_G
    v = F.when(small & (g == F.floor(g)), g.cast("long") * 10 ** DIGITS).when(small & (micro / 1e6 == g), micro.cast("long") * 10 ** (DIGITS - 6))
    wild = F.isnan(g) | (F.abs(g) >= LARGE_SERVING_G)
    return _make(v, F.when(v.isNull() & ~wild, g.cast(_SERVING)), F.when(wild, g))


# ------------------------------------------------------------------------ sums
def _folded(hi: Column, lo: Column, d: Column, x: Column) -> Column:
    top = hi + F.shiftright(lo, _LIMB)
    low = lo.bitwiseAND(F.lit(_MASK))
    fits = d.isNull() & (F.abs(top) < (1 << 32))
    units = (top.cast("decimal(19,0)") * _LIMB_UNIT + low.cast("decimal(10,0)") * _UNIT).cast(_ADDEND)
    wide = F.when(hi.isNotNull() & ~fits, units + F.coalesce(d, F.lit(0)).cast(_ADDEND)).otherwise(d)
    return _make(F.when(fits, F.shiftleft(top, _LIMB) + low), wide, x)


def _sums(name: str) -> list[Column]:
    return [F.sum(F.shiftright(F.col(name)["v"], _LIMB)), F.sum(F.col(name)["v"].bitwiseAND(F.lit(_MASK))),
            *[F.expr(f"sum({name}.{c}) FILTER (WHERE {name}.{c} IS NOT NULL)") for c in "dx"]]


def total(name: str) -> Column:
    """Aggregate: the exact sum of a gram column (NULLs skipped)."""
    return _folded(*_sums(name))


def totals(df: DataFrame, keys: list[str], names: list[str], *others: Column) -> DataFrame:
    """``keys``, the ``others`` aggregated, and ``_totals``, an array of the exact sums of the gram columns ``names``.

    Carries are folded behind the aggregate by one higher-order function, however many columns there are: as part of the
    aggregate they would be repeated in its compiled code for each."""
    raw = df.groupBy(*keys).agg(*[c.alias(f"_{i}_{k}") for i, n in enumerate(names) for k, c in enumerate(_sums(n))], *others)
    parts = [F.struct(*[F.col(f"_{i}_{k}").alias(p) for k, p in enumerate(("hi", "lo", "d", "x"))]) for i in range(len(names))]
    kept = [c for c in raw.columns if not (c.startswith("_") and c[1].isdigit())]
    return raw.select(*kept, F.transform(F.array(*parts), lambda s: _folded(s["hi"], s["lo"], s["d"], s["x"])).alias("_totals"))


def running_parts(name: str, over: Window) -> Column:
    """Limbs and other parts of the sum over a window frame, to be ``folded``."""
    v, d, x = _parts(name)
    return F.struct(F.sum(F.shiftright(v, _LIMB)).over(over).alias("hi"), F.sum(v.bitwiseAND(F.lit(_MASK))).over(over).alias("lo"),
                    F.sum(d).over(over).alias("d"), F.sum(x).over(over).alias("x"))


def folded(parts: Column) -> Column:
    return _folded(parts["hi"], parts["lo"], parts["d"], parts["x"])


def running(name: str, over: Window) -> Column:
    """The exact sum over a window frame."""
    return folded(running_parts(name, over))


# ----------------------------------------------------------------- other forms
def _exact(v: Column, d: Column) -> Column:
    return F.coalesce((v.cast("decimal(19,0)") * _UNIT).cast(EXACT), d)


def to_decimal(g: str | Column) -> Column:
    """DECIMAL(38,18); NULL where ``x`` is set."""
    v, d, x = _parts(g)
    return F.when(x.isNull(), _exact(v, d))


def to_double(g: str | Column) -> Column:
    """The nearest double. Units that a double holds whole are divided once, which rounds once."""
    v, d, x = _parts(g)
    # 2^53 units are 9007 g, 2^53 times a thousand more than any v
    exact = F.when(F.abs(v) < (1 << 53), v.cast("double") / F.lit(1e12)).when(
        v % 1000 == 0, F.call_function("div", v, F.lit(1000)).cast("double") / F.lit(1e9)).otherwise(
        F.get(seldom(F.coalesce(F.abs(v) >= (1 << 53), d.isNotNull()), F.array(F.struct(v.alias("v"), d.alias("d"))),
                     lambda s: _exact(s["v"], s["d"]).cast("double")), F.lit(0)))
    return F.when(x.isNull(), exact).otherwise(x + F.coalesce(exact, F.lit(0.0)))


def round2(g: str | Column) -> Column:
    """DOUBLE, the exact amount rounded half up (away from zero) to two decimals."""
    v, d, x = _parts(g)
    cent, half = 10 ** (DIGITS - 2), 5 * 10 ** (DIGITS - 3)
    rest = v % cent
    cents = (v - rest).cast("double") / F.lit(float(cent)) + F.when(F.abs(rest) >= half, F.signum(rest.cast("double"))).otherwise(F.lit(0.0))
    exact = F.when(v.isNotNull() & (F.abs(v) < (1 << 62)), cents / F.lit(100.0)).otherwise(F.round(_exact(v, d), 2).cast("double"))
    return F.when(x.isNull(), exact).otherwise(F.round(to_double(g) * 100.0) / 100.0)


def average2(sum_: Column, count: Column) -> Column:
    """``double(sum) / count``, rounded to two decimals as the warehouse engine does."""
    from . import round_half_away
    return round_half_away(F.try_divide(to_double(sum_), count.cast("double")), 2)


def as_decimals(df: DataFrame) -> DataFrame:
    """Every gram column as DECIMAL(38,18), the form for SQL users and files."""
    return df.select(*[to_decimal(f.name).alias(f.name) if isinstance(f.dataType, StructType) and f.dataType.names == ["v", "d", "x"]
                       else F.col(f.name) for f in df.schema.fields])
