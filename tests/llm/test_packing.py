import random
import zlib
from collections import defaultdict

import numpy as np
import pytest

from platewise.llm import packing as M
from platewise.llm.tokens import FastTokenizer


def best_bins(sizes, capacity):
    """Fewest bins, by trying all."""
    best = [len(sizes)]

    def go(k, bins):
        if len(bins) >= best[0]:
            return
        if k == len(sizes):
            best[0] = len(bins)
            return
        for room in sorted({b for b in bins if b >= sizes[k]}):
            rest = list(bins)
            rest[rest.index(room)] = room - sizes[k]
            go(k + 1, rest)
        go(k + 1, [*bins, capacity - sizes[k]])

    go(0, [])
    return best[0]


def test_bounds_never_exceed_the_best_packing():
    random.seed(2)
    tight = 0
    for _ in range(200):
        capacity = random.choice([10, 12, 17, 100])
        sizes = np.array(sorted((random.randint(1, capacity) for _ in range(random.randint(1, 8))), reverse=True))
        bound, best = M.lower_bound(sizes, capacity), best_bins(sizes.tolist(), capacity)
        assert -(-sizes.sum() // capacity) <= bound <= best
        where, offset, free = M.best_fit_decreasing(sizes, capacity)
        assert best <= len(free) and (free >= 0).all()
        tight += bound == best
    assert tight > 150
    assert M.lower_bound(np.array([6, 6, 6]), 10) == 3 and M.lower_bound(np.zeros(0, int), 10) == 0


def whole(rows, placed, capacity):
    """Checks contract and gaplessness; returns the number of sequences."""
    want = []
    for (i, _), ids in zip(rows, FastTokenizer().ids([t or "" for _, t in rows])):
        ids = np.append(ids, 1).astype("<u4")
        want += [(i, k, s, len(ids[s:s + capacity]), zlib.crc32(ids[s:s + capacity].tobytes()))
                 for k, s in enumerate(range(0, len(ids), capacity))]
    got = [(r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in placed]
    assert sorted(got, key=str) == sorted(want, key=str)
    by = defaultdict(list)
    for r in placed:
        by[r.sequence_id].append((r.offset, r.length))
    for parts in by.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= capacity
    return len(by)


@pytest.mark.parametrize("capacity", [64, 4096])
def test_documents_are_packed_whole(spark, docs, capacity):
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    placed = M.pack_documents(docs, capacity=capacity, per_partition=40).collect()
    n = whole(rows, placed, capacity)
    sizes = np.array([r.length for r in placed])
    assert n <= M.lower_bound(sizes, capacity) * 1.02 + 1


def test_exchange_saves_bins(spark):
    """Small partitions have more bins than the whole needs; exchanges bring them near the bound of all items."""
    rng = random.Random(4)
    rows = [(i, 0, 0, rng.randint(5, 60), 0, i) for i in range(600)]
    cut = spark.createDataFrame(rows, "doc_id long, piece int, start long, length long, ids_crc32 long, pid long")
    bins = [M.pack(cut, capacity=100, per_partition=20, rounds=k).select("sequence_id").distinct().count() for k in (1, 4)]
    bound = M.lower_bound(np.array([r[3] for r in rows]), 100)
    assert bound <= bins[1] < bins[0]
    placed = M.pack(cut, capacity=100, per_partition=20, rounds=4).collect()
    assert len(placed) == 600 and len({(r.sequence_id, r.offset) for r in placed}) == 600


def test_odd_rows_and_ids(spark, odd, odd_rows, none):
    placed = M.pack_documents(odd, capacity=128, keep_ids=True).collect()
    whole(odd_rows, placed, 128)
    assert all(zlib.crc32(bytes(r.ids)) == r.ids_crc32 for r in placed)
    assert M.digest(M.pack_documents(none)).count() == 0


def test_exchanges_go_on_while_they_save_bins(spark):
    rng = random.Random(4)
    rows = [(i, 0, 0, rng.randint(25, 55), 0, i) for i in range(800)]
    cut = spark.createDataFrame(rows, "doc_id long, piece int, start long, length long, ids_crc32 long, pid long")
    few, placed = M.pack(cut, capacity=100, per_partition=10, rounds=4).collect(), M.pack(cut, capacity=100, per_partition=10).collect()
    assert len({r.sequence_id for r in placed}) < len({r.sequence_id for r in few}) and max(r["round"] for r in placed) > 3
    held = defaultdict(int)
    for r in placed:
        held[r.sequence_id] += r.length
    assert len(placed) == 800 and max(held.values()) <= 100 and len({(r.sequence_id, r.offset) for r in placed}) == 800
