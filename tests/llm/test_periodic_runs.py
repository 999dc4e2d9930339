import hashlib
import random
import re
import zlib
from fractions import Fraction

import pytest

from platewise.llm import catalog
from platewise.llm import periodic_runs as M


def brute(w, least=6):
    """Every maximal stretch of four periods or more, by trying all periods."""
    out = set()
    for q in range(1, len(w) // 4 + 1):
        i = 0
        while i < len(w) - q:
            j = i
            while j < len(w) - q and w[j] == w[j + q]:
                j += 1
            s, e = i, j + q
            if e - s >= max(least, 4 * q) and all(any(w[k] != w[k + p] for k in range(s, e - p)) for p in range(1, q)):
                out.add((s, e - s, q))
            i = max(j, i + 1)
    return sorted(out, key=lambda r: (r[0], r[2]))


def collapsed(w, runs):
    gone = {k for s, n, q in runs for k in range(s + q, s + n)}
    return " ".join(x for k, x in enumerate(w) if k not in gone)


def fibonacci(n):
    a, b = ["a"], ["a", "b"]
    while len(b) < n:
        a, b = b, b + a
    return b[:n]


def some(rng):
    n, kind = rng.randint(0, 200), rng.randint(0, 5)
    if kind == 0:
        return [rng.choice("ab") for _ in range(n)]
    if kind == 1:
        return fibonacci(n)
    if kind == 2:  # blocks with a long stretch of one word within the period
        return ((["a"] * rng.randint(1, 40) + ["b"]) * rng.randint(1, 8) + ["a"] * rng.randint(0, 60)) * rng.randint(1, 4)
    w = []
    while kind < 5 and len(w) < n:
        w += [rng.choice("abcdefgh"[:rng.randint(1, 8)]) for _ in range(rng.randint(1, 60))] * rng.randint(1, 9)
    return w or [str(rng.randint(0, 300)) for _ in range(n)]


@pytest.mark.parametrize("seed", range(8))
def test_runs_equal_brute_force(seed):
    rng = random.Random(seed)
    for _ in range(60):
        words = [some(rng) for _ in range(rng.randint(0, 4))]
        runs, kept = M.runs_of([" ".join(w).encode() for w in words])
        for w, r, k in zip(words, runs, kept):
            want = brute(w)
            assert [(x["start"], x["length"], x["period"]) for x in r] == want, w
            assert k.decode() == collapsed(w, want)


def test_large_periods_and_long_texts():
    rng = random.Random(1)
    for q in (1, 2, 7, 8, 9, 15, 16, 17, 31, 33, 127, 500, 1024, 3001):
        own = [str(rng.randint(0, 5 + q)) for _ in range(q)]
        own[0] = "once"
        w = ["x", "y"] + own * 4 + own[:q // 2] + ["z"]
        runs, _ = M.runs_of([" ".join(w).encode()])
        if len(own * 4 + own[:q // 2]) >= 6:
            assert {"start": 2, "length": 4 * q + q // 2, "period": q} in runs[0], q
    runs, kept = M.runs_of([b"again " * 200_000])
    assert runs == [[{"start": 0, "length": 200_000, "period": 1}]] and kept == [b"again"]


def test_synchronising_positions_are_sparse_in_periodic_regions():
    import numpy as np
    ids = np.tile(np.arange(3), 400)  # period 3: no positions at scales of 12 words and more
    regions = M.stretches(ids, [len(ids)])
    assert regions == [(0, 1200, 3)]
    rng = np.random.default_rng(1)
    h = rng.integers(0, 1 << 63, 10_000, dtype=np.uint64)
    for tau in (8, 64, 512):
        least = M.window_min(h, tau + 1)
        assert np.array_equal(least, [h[i:i + tau + 1].min() for i in range(len(h) - tau)])
        chosen = np.flatnonzero((least == h[:-tau]) | (least == h[tau:]))
        assert len(chosen) < 4 * len(h) / tau and np.diff(chosen).max() <= tau


def looped(i, text):
    w = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    h = zlib.crc32(("" if i is None else str(i)).encode())
    if h % 10 or not w:
        return w
    g, n = h // 10, len(w)
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [w[k] if k < a else w[a + (k - a) % p] for k in range(n)]


def expected(i, text):
    w = looped(i, text)
    runs = brute(w)
    best = min(runs, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2])) if runs else None
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    return (i, len(runs), *(best or (None,) * 3), 1000 * best[1] // best[2] if best else None,
            sha("".join(f"{s},{n},{q}\n" for s, n, q in runs)), sha(collapsed(w, runs)))


def test_query_equals_brute_force(spark, sf, docs):
    got = catalog.QUERIES["op11_periodic_runs"](spark, sf).collect()
    want = [expected(r.doc_id, r.text if len(r.text or "") < 20_000 else None) for r in docs.collect()]
    long = {r.doc_id for r in docs.collect() if len(r.text or "") >= 20_000}
    pick = lambda rows: sorted([tuple(r) for r in rows if r[0] not in long], key=str)
    assert pick(got) == pick(want) and len(got) == len(want)
    assert sum(r.n_runs for r in got) > 0


def test_special_rows(spark, odd, odd_rows, none):
    words = ["a b c " * 4, "v " * 6, "v " * 5, "\t\x0b\x0c\r\n", "v\u00a0v v\u00a0v", "ß 漢 " * 5]
    rows = [(i, t if t is None or len(t) < 100_000 else "w " * 50) for i, t in odd_rows] + list(enumerate(words * 3, 100))
    got = M.document_runs(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted(map(tuple, got), key=str) == sorted([expected(*r) for r in rows], key=str)
    out = M.find_runs(odd.withColumnRenamed("fp", "runs"))
    assert out.columns == ["doc_id", "text", "TEXT", "row", "score", "lang", "runs", "collapsed"] and out.count() == len(odd_rows)
    assert M.find_runs(none).count() == 0 and M.document_runs(none).count() == 0


def test_fewer_than_four_periods_are_refused():
    with pytest.raises(ValueError):
        M.runs_of([b"a a a"], fold=3)
