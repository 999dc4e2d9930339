import math
import zlib
from collections import Counter

import numpy as np

from platewise.llm import lm_scoring as M


def brute(rows):
    """Counts, base scores and totals of (doc_id, text) rows."""
    words = [((t or "").encode().lower().split() + [None], zlib.crc32(("" if i is None else str(i)).encode()) % 7) for i, t in rows]
    c, pairs = Counter(), Counter()
    for w, fold in words:
        if fold != 2:
            c.update(w)
            pairs.update(zip([b"<"] + w[:-1], w))
    return words, c, pairs


def check(got, rows, weights):
    words, c, pairs = brute(rows)
    n, kinds, begin = sum(c.values()), len(c), sum(f != 2 for _, f in words)
    want = []
    for (i, _), (w, fold) in zip(rows, words):
        base = sum(math.log10((c[x] + 1) / (n + kinds + 1)) for x in w)
        score = 0.0
        for v, x in zip([b"<"] + w[:-1], w):
            ctx = begin if v == b"<" else c[v]
            a, u, z = weights[int(M._bucket(np.array([ctx]))[0])]
            score += math.log10((a * pairs[v, x] / ctx if ctx else 0) + (u * c[x] / n if n else 0) + z / (kinds + 1))
        want.append((i, fold == 2, len(w), sum(c[x] > 0 for x in w), n, base, score))
    key = lambda r: (r[0] is None, r[0] or 0, r[2])
    for g, x in zip(sorted(map(tuple, got), key=key), sorted(want, key=key), strict=True):
        assert g[:5] == x[:5]
        assert math.isclose(g[5], x[5], rel_tol=1e-9, abs_tol=1e-9) and math.isclose(g[6], x[6], rel_tol=1e-9, abs_tol=1e-9)


def test_scores_equal_brute_force(spark, docs):
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    blocks = M.resolved(docs, block_bytes=40_000)
    model = M.fit(blocks)
    check(M.score(blocks, model).collect(), rows, model["weights"])
    own = sum(r.score for r in M.score(blocks, model).where("held_out").collect())
    base = sum(r.base_score for r in M.score(blocks, model).where("held_out").collect())
    assert own > base


def test_odd_rows(spark, odd, odd_rows, none):
    blocks = M.resolved(odd, block_bytes=2000)
    model = M.fit(blocks)
    check(M.score(blocks, model).collect(), odd_rows, model["weights"])
    assert M.score_documents(none).count() == 0


def test_without_training_rows_all_is_uniform(spark):
    held = [i for i in range(100) if zlib.crc32(str(i).encode()) % 7 == 2][:3]
    df = spark.createDataFrame([(i, "a b") for i in held], "doc_id long, text string")
    for r in M.score_documents(df).collect():
        assert r.train_tokens == 0 and r.n_known == 0 and r.score == 0.0 and r.base_score == 0.0


def test_probabilities_of_every_context_sum_to_one(spark, docs):
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    _, c, pairs = brute(rows)
    w = M.fit(M.resolved(docs))["weights"]
    n, kinds = sum(c.values()), len(c)
    for v in [x for x, _ in c.most_common(3)] + [x for x in list(c)[:20]]:
        if v is None:
            continue
        a, u, z = w[int(M._bucket(np.array([c[v]]))[0])]
        total = sum(a * pairs[v, x] / c[v] + u * c[x] / n + z / (kinds + 1) for x in c) + z / (kinds + 1)
        assert math.isclose(total, 1, rel_tol=1e-9)


def test_weights_reach_the_best_likelihood():
    rng = np.random.default_rng(3)
    share, single = rng.random(400) * (rng.random(400) < 0.5), rng.integers(0, 50, 400).astype(float)
    bucket, n = rng.integers(1, 3, 400), rng.integers(1, 2000, 400).astype(float)
    w = M.learn(bucket, n, share * n, single * n, 10, 5000, 99)
    assert np.allclose(w.sum(axis=1), 1) and w[0, 0] == 0
    for b in (1, 2):
        own = bucket == b
        p = np.column_stack([share, single / 5000, np.full(400, 0.01)])[own]
        value = lambda x: (n[own] * np.log(p @ x)).sum()
        best = max(value(x) for x in rng.dirichlet(np.ones(3), 4000))
        assert value(w[b]) >= best - 1e-3 * abs(best)
