"""X1 with state: equal to the batch answer for any order of files; late rows apart; replays, restarts, bounded sink."""

import datetime as dt
import os
import random

from test_streaming import TS, foods, land

from platewise.functions import grams as G
from platewise.operators import versions as V
from platewise.streaming import stateful_stream as X

ITEMS = "user_id long, meal_id int, fdc_id long, grams double, logged_date date, logged_date_id int"


def protein(spark, sink):
    rows = X.read_daily(spark, sink).where("nutrient_id = 1")
    return {(r.user_id, r.logged_date): float(r.x) for r in rows.select("user_id", "logged_date", G.to_double("daily_value_g").alias("x")).collect()}


def test_late_rows_go_to_the_side_table_and_count(spark, scratch):
    landing, sink, ckpt = f"{scratch}/landing", f"{scratch}/daily", f"{scratch}/_ckpt"
    run = lambda: X.run_daily_intake(spark, landing, foods(spark), sink, ckpt, max_files_per_trigger=1)
    land(spark, landing, [(1, [(10, 10.0)], None, None, TS(2024, 1, 10, 8)), (1, [(10, 20.0)], None, None, TS(2024, 1, 7, 8))])
    run()
    land(spark, landing, [(1, [(10, 100.0)], None, None, TS(2024, 1, 9, 8)), (2, [(10, 50.0)], [], None, TS(2024, 1, 10, 8))])
    run()  # restarted from its checkpoint; nothing late: two days behind is in time
    assert X.read_late(spark, sink).count() == 0
    land(spark, landing, [(1, [(10, 30.0)], None, None, TS(2024, 1, 7, 9)), (3, [(10, 10.0)], None, None, TS(2024, 1, 20, 9))])
    run()
    late = X.read_late(spark, sink).collect()
    assert [(r.user_id, r.logged_date) for r in late] == [(1, dt.date(2024, 1, 7))]
    assert protein(spark, sink) == {(1, dt.date(2024, 1, 10)): 1.0, (1, dt.date(2024, 1, 7)): 5.0, (1, dt.date(2024, 1, 9)): 10.0,
                                    (2, dt.date(2024, 1, 10)): 5.0, (3, dt.date(2024, 1, 20)): 1.0}
    state = V.read(spark, f"{sink}/state")  # days before the watermark have left it
    assert [r.user_id for r in state.collect()] == [3]
    run()
    assert len(protein(spark, sink)) == 5


def test_any_order_replays_and_tiers(spark, scratch, monkeypatch):
    from platewise.operators import transforms as T
    monkeypatch.setattr(X, "FOLD", 2)
    rng, sink = random.Random(4), f"{scratch}/daily"
    merge, total, kept = X.merge_batch(sink, 1), {}, []
    for batch in range(7):
        rows = []
        for _ in range(6):
            user, day, grams = rng.randint(1, 2), dt.date(2024, 1, rng.randint(1, 4) + batch), float(rng.randint(1, 50))
            rows.append((user, 1, 10, grams, day, 0))
            total[user, day] = total.get((user, day), 0) + grams / 10
        scaled = T.scaled_exact(spark.createDataFrame(rows, ITEMS), foods(spark))
        if batch == 3:  # ends before its pointer is there, and is replayed
            with monkeypatch.context() as m:
                m.setattr(V, "point_to", lambda *a, **k: (_ for _ in ()).throw(KeyboardInterrupt()))
                try:
                    merge(scaled, batch)
                except KeyboardInterrupt:
                    pass
            assert protein(spark, sink) == kept[-1]
        merge(scaled, batch)
        merge(scaled, batch)  # replayed after it counted
        kept.append(protein(spark, sink))
    assert {k: round(v, 6) for k, v in kept[-1].items()} == {k: round(v, 6) for k, v in total.items()}
    for kind in X.KINDS:
        folders = [n for n in os.listdir(f"{sink}/{kind}") if n.startswith("t")]
        assert len(folders) <= 3 and any(not n.startswith("t0") for n in folders), folders
