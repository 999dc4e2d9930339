import math

import numpy as np
import pytest

from platewise.llm import vptree as M


def brute(rows, k=10, every=100):
    ok = [(i, np.array(v, float)) for i, v in rows
          if i is not None and v and None not in v and all(map(math.isfinite, v)) and any(v)]
    out = []
    for a, (q, v) in enumerate(ok):
        if q % every == 0:
            near = sorted((math.sqrt(((v - w) ** 2).sum()), i) for b, (i, w) in enumerate(ok) if b != a and len(w) == len(v))
            out += [(q, r + 1, i, d) for r, (d, i) in enumerate(near[:k])]
    return sorted(out)


def frame(spark, rows):
    return spark.createDataFrame([(i, v, "x", 0.0) for i, v in rows], "vec_id long, embedding array<float>, score string, rank double")


def same(got, want):
    got = sorted(map(tuple, got))
    assert [(g[0], g[1], g[2]) for g in got] == [(w[0], w[1], w[2]) for w in want]
    assert all(math.isclose(g[3], w[3], abs_tol=1e-12) for g, w in zip(got, want))


def test_factor_one_is_exact(spark, sf):
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{sf}/embeddings.parquet").collect()]
    rows = [(i, v[:4]) for i, v in rows]  # few dimensions, so that branches are skipped
    same(M.nearest(frame(spark, rows), factor=1, every=10, shard_rows=90).collect(), brute(rows, every=10))


def test_pruning_skips_distances_and_relaxing_skips_more():
    rng = np.random.default_rng(0)
    x = rng.normal(size=(4000, 3))
    tree = M.build(np.arange(4000), np.arange(4000), x)
    taken = [M.search(tree, x[5], 5, factor=f)[2] for f in (1, 3)]
    assert taken[1] < taken[0] < 2000


def test_ties_repeats_and_odd_vectors(spark):
    rows = [(i, [1.0, 2.0]) for i in range(300)] + [(100, [1.0, 2.0]), (400, [0.0, 0.0]), (500, None), (600, [1.0, None]),
            (700, [float("nan"), 1.0]), (800, [float("inf"), 1.0]), (None, [1.0, 1.0]), (900, []), (1000, [5.0, 5.0, 5.0]),
            (1100, [3.0, 2.0]), (301, [1.5, 2.0])]
    same(M.nearest(frame(spark, rows), factor=1, shard_rows=64).collect(), brute(rows))


def test_fewer_candidates_and_none(spark):
    rows = [(0, [1.0]), (1, [2.0]), (2, [4.0])]
    same(M.nearest(frame(spark, rows)).collect(), brute(rows))
    assert M.nearest(frame(spark, rows[:1])).count() == 0
    assert M.nearest(frame(spark, [])).count() == 0


def test_recall_of_the_registered_factor(spark, sf):
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{sf}/embeddings.parquet").collect()]
    want = {(q, i) for q, _, i, _ in brute(rows, every=10)}
    got = {(r.query_id, r.vec_id) for r in M.nearest(frame(spark, rows), every=10, shard_rows=200).collect()}
    assert len(want & got) >= 0.9 * len(want)
