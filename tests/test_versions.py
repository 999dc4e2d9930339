"""Tables replaced whole by a pointer, and snapshots that a run that ends early leaves as they were."""

import os

import pytest

from platewise.operators import versions as V
from platewise.operators import writes as W


def numbers(spark, *ids):
    return spark.createDataFrame([(i,) for i in ids], "id int")


def ids(spark, path):
    return sorted(r.id for r in V.read(spark, path).collect())


def test_publish_replaces_and_old_versions_go_later(spark, scratch):
    path = f"{scratch}/t"
    for k in range(1, 5):
        V.publish(numbers(spark, *range(k)), path)
        assert ids(spark, path) == list(range(k))
    assert len(os.listdir(f"{path}/_versions")) == V.KEEP and V.current(spark, path).number == 4
    V.publish(V.read(spark, path).where("id > 1"), path)  # from its own current version
    assert ids(spark, path) == [2, 3]


def test_a_job_killed_between_the_writes_leaves_the_old_version(spark, scratch, monkeypatch):
    path = f"{scratch}/t"
    V.publish(numbers(spark, 1, 2), path)
    with monkeypatch.context() as m:
        m.setattr(V, "point_to", lambda *a, **k: (_ for _ in ()).throw(KeyboardInterrupt()))
        with pytest.raises(KeyboardInterrupt):
            V.publish(numbers(spark, 9), path)
    assert ids(spark, path) == [1, 2] and len(os.listdir(f"{path}/_versions")) == 2
    V.publish(numbers(spark, 3), path)
    assert ids(spark, path) == [3]
    assert len(os.listdir(f"{path}/_versions")) == 2  # what the killed job wrote is gone


def test_only_one_of_two_jobs_publishes_a_number(spark, scratch):
    path = f"{scratch}/t"
    V.publish(numbers(spark, 1), path)
    mine = V.planned(spark, path)
    numbers(spark, 5).write.parquet(V.folder_of(path, mine))
    V.publish(numbers(spark, 2), path)
    with pytest.raises(RuntimeError, match="another job"):
        V.point_to(spark, path, mine)
    assert ids(spark, path) == [2]


def foods(spark, *rows):
    return spark.createDataFrame(rows, "fdc_id long, name string, protein_g double")


def test_a_snapshot_run_that_ends_early_changes_nothing(spark, scratch, monkeypatch):
    path = f"{scratch}/snap"
    run = lambda at, *rows: W.snapshot_check(foods(spark, *rows), path, "fdc_id", ["protein_g"], at)
    seen = lambda: sorted(map(str, W.read_snapshot(spark, path).collect()))
    run("2024-02-01 00:00:00", (1, "a", 1.0), (2, "b", 2.0))
    before = seen()
    with monkeypatch.context() as m:
        m.setattr(V, "point_to", lambda *a, **k: (_ for _ in ()).throw(KeyboardInterrupt()))
        with pytest.raises(KeyboardInterrupt):
            run("2024-03-01 00:00:00", (1, "a", 5.0), (2, "b", 2.0))
    assert seen() == before  # its closed row is there, but not read
    run("2024-03-01 00:00:00", (1, "a", 7.0), (2, "b", 2.0), (3, "c", None))
    after = seen()
    assert len(after) == 4 and sum("2024, 3, 1" in r and "protein_g=1.0" in r for r in after) == 1
    run("2024-03-01 00:00:00", (1, "a", 8.0), (2, "b", 2.0))  # once more at the same time: its closed rows are kept
    assert sum("protein_g=1.0" in r for r in seen()) == 1 and sum("protein_g=7.0" in r for r in seen()) == 1


def test_no_row_of_the_snapshot_is_moved(spark, scratch, monkeypatch):
    path, plans = f"{scratch}/snap", []
    W.snapshot_check(foods(spark, (1, "a", 1.0), (2, "b", 2.0)), path, "fdc_id", ["protein_g"], "2024-02-01 00:00:00")
    real = W.snapshot_joined

    def watched(*args):
        out = real(*args)
        plans.append(out._jdf.queryExecution().executedPlan().toString())
        return out

    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    monkeypatch.setattr(W, "snapshot_joined", watched)
    try:
        W.snapshot_check(foods(spark, (1, "a", 1.5), (3, "c", 3.0)), path, "fdc_id", ["protein_g"], "2024-03-01 00:00:00")
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert "Exchange" not in plans[0] and "Bucketed: true" in plans[0]
    assert W.read_snapshot(spark, path).count() == 4
