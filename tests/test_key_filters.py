"""New keys against the Bloom filters of stored partitions."""

import random

from pyspark.sql import functions as F

from platewise.operators import key_filters as K


def test_planted_duplicates_are_found_and_other_partitions_not_read(spark, scratch):
    rng = random.Random(5)
    keys = rng.sample(range(10 ** 9), 12_000)
    rows = [(k, f"p{i % 12}") for i, k in enumerate(keys)] + [(keys[0], "p0"), (None, "p3")]
    spark.createDataFrame(rows, "id long, part string").write.partitionBy("part").parquet(f"{scratch}/t")
    stored = spark.read.parquet(f"{scratch}/t")
    K.write_filters(stored, f"{scratch}/f", "part", "id")
    planted = [keys[12 * j + 4] for j in range(20)] + [keys[0]]
    new = [-k for k in rng.sample(range(1, 10 ** 9), 5000)]
    load = spark.createDataFrame([(k,) for k in planted * 2 + new + [None]], "id long")
    named = K.candidates(load, "id", spark.read.parquet(f"{scratch}/f")).collect()
    assert {(r.key, r.part) for r in named} >= {(k, "p4") for k in planted[:-1]} | {(keys[0], "p0")}
    assert {r.part for r in named} == {"p0", "p4"}
    got = K.stored_duplicates(spark, load, f"{scratch}/t", f"{scratch}/f", "part", "id")
    assert sorted((r.key, r.part, r.stored) for r in got.collect()) == sorted(
        [(k, "p4", 1) for k in planted[:-1]] + [(keys[0], "p0", 2)])
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [part#" in plan and " IN (" in plan
    assert K.stored_duplicates(spark, load.limit(0), f"{scratch}/t", f"{scratch}/f", "part", "id").count() == 0


def test_no_key_is_missed_and_filters_of_large_partitions_span_bitmaps(spark):
    rows = spark.range(3000).select((F.col("id") * 7919).alias("id"), F.lit("a").alias("part"))
    f = K.filters_of(rows, "part", "id").cache()
    assert f.select("size").distinct().collect()[0].size == 1 << 18 and f.count() == 8
    assert K.candidates(rows, "id", f).count() == 3000
    other = spark.range(20_000).select((F.col("id") * 7919 + 1).alias("id"))
    assert K.candidates(other, "id", f).count() <= 2


def test_a_key_is_asked_of_one_block_of_each_partition(spark):
    rows = spark.range(3000).select((F.col("id") * 7919).alias("id"), F.lit("a").alias("part"))
    f = K.filters_of(rows.unionByName(rows.withColumn("part", F.lit("b"))), "part", "id").cache()
    found = [K.candidates(rows, "id", f.where(F.col("block") == k)).count() for k in range(8)]
    assert sum(found) == 6000 and min(found) > 400
    plan = K.candidates(rows, "id", f)._jdf.queryExecution().executedPlan().toString()
    assert "FlatMapCoGroupsInArrow" in plan and "SortMergeJoin" not in plan


def test_packs_hold_all_keys_and_repeated_rows(spark, monkeypatch):
    monkeypatch.setattr(K, "PACK", 100)
    monkeypatch.setattr(K, "HELD", 1000)
    monkeypatch.setattr(K, "_SLAB", 3)
    rows = spark.range(4000).select(F.when(F.col("id") < 2000, F.col("id")).otherwise(7).alias("id"), (F.col("id") % 3).alias("part"))
    f = K.filters_of(rows.repartition(4), "part", "id").cache()
    assert f.count() == f.select("part", "block").distinct().count()
    got = K.candidates(rows.select(F.col("id").cast("long")), "id", f)
    want = {(r.id, r.part) for r in rows.distinct().collect()}
    assert sorted(map(tuple, got.collect())) == sorted(want)


def test_empty_table(spark):
    none = spark.createDataFrame([], "id long, part string")
    assert K.filters_of(none, "part", "id").count() == 0
    assert K.candidates(none, "id", K.filters_of(none, "part", "id")).count() == 0
