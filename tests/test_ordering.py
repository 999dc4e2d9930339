"""Positions over several keys, mixed directions, NULLs first or last."""

import random

from pyspark.sql import functions as F

from platewise.operators.ordering import with_position


def test_positions_of_a_mixed_order(spark):
    rng = random.Random(2)
    rows = [(k, rng.choice([None, 1, 2, 3]), rng.choice([None, "a", "B", "é", ""]), rng.choice([1.5, -0.5, None])) for k in range(500)]
    df = spark.createDataFrame(rows, "id int, a int, b string, c double").repartition(7)
    got = with_position(df, F.col("a").desc_nulls_first(), F.col("b").asc_nulls_last(), F.col("c").desc_nulls_last(), F.col("id")).collect()
    key = lambda r: (r[1] is not None, -(r[1] or 0), r[2] is None, (r[2] or "").encode(), r[3] is None, -(r[3] or 0), r[0])
    want = {r[0]: n for n, r in enumerate(sorted(rows, key=key), 1)}
    assert {r.id: r.position for r in got} == want
    assert with_position(df.limit(0), F.col("a")).count() == 0
