import random

import numpy as np
import xxhash

from platewise.llm import simhash as M
from platewise.llm.components import components


def fingerprint(text):
    w = (text or "").encode().lower().split()
    s = [b" ".join(w[i:i + 3]) for i in range(len(w) - 2)] or ([b" ".join(w)] if w else [])
    h = [xxhash.xxh64_intdigest(x, 42) for x in s]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def classes(fps, tau=3):
    """Fingerprint -> smallest fingerprint reachable, as signed numbers, by trying all pairs."""
    own = sorted(set(fps))
    root = {f: f for f in own}

    def find(f):
        while root[f] != f:
            f = root[f]
        return f

    for i, a in enumerate(own):
        for b in own[:i]:
            if (a ^ b).bit_count() <= tau:
                x, y = sorted((find(a), find(b)))
                root[y] = x
    return {f: find(f) for f in own}


def check(got, rows):
    fp = [fingerprint(t) for _, t in rows]
    label = classes(fp)
    least = {}
    for (i, _), f in zip(rows, fp):
        if i is not None:
            least[label[f]] = min(i, least.get(label[f], i))
    want = [(i, f"{f:016x}", least.get(label[f])) for (i, _), f in zip(rows, fp)]
    assert sorted(map(tuple, got), key=str) == sorted(want, key=str)


def test_documents_equal_brute_force(spark, docs):
    check(M.digest(docs).collect(), [(r.doc_id, r.text) for r in docs.collect()])


def test_odd_rows(spark, odd, odd_rows, none):
    check(M.digest(odd).collect(), odd_rows)
    assert M.digest(none).count() == 0 and M.deduplicate(none).columns == none.columns
    left = M.deduplicate(odd)
    assert left.columns == odd.columns
    kept = sorted((r[0] for r in left.collect()), key=str)
    fp = [fingerprint(t) for _, t in odd_rows]
    label = classes(fp)
    first = {}
    for (i, _), f in zip(odd_rows, fp):
        first[label[f]] = min((i is None, i or 0), first.get(label[f], (True, 1 << 60)))
    assert kept == sorted((None if n else i for n, i in first.values()), key=str)


def planted(n, seed, spread=3):
    rng = random.Random(seed)
    bias = rng.getrandbits(64) & rng.getrandbits(64)  # correlated bits
    out = []
    for _ in range(n):
        f = rng.getrandbits(64) | bias if rng.random() < 0.7 else rng.getrandbits(64)
        out.append(f)
        for _ in range(rng.choice([0, 0, 1, 3])):
            for b in rng.sample(range(64), rng.randint(0, spread + 1)):
                f ^= 1 << b
            out.append(f)
    return out


def test_links_are_all_pairs_within_the_distance(spark):
    for tau in (0, 1, 2, 3, 4):
        fps = sorted(set(planted(250, tau, tau)))
        df = spark.createDataFrame([(int(np.uint64(f).astype(np.int64)),) for f in fps], "fp long")
        got = {tuple(r) for r in M.links(df, tau, sample=100).collect()}
        signed = [int(np.uint64(f).astype(np.int64)) for f in fps]
        want = {tuple(sorted((signed[i], signed[j]))) for i in range(len(fps)) for j in range(i)
                if (fps[i] ^ fps[j]).bit_count() <= tau}
        assert got == want and (want or not tau)


def test_thresholds_add_up_and_follow_the_counts():
    fp = np.array(planted(300, 9), dtype=np.uint64)
    bits = np.unpackbits(fp.astype(">u8").view(np.uint8).reshape(-1, 8), axis=1).astype(float)
    for m in (2, 3, 4):
        groups = M.group_bits(bits, m)
        assert sorted(b for g in groups for b in g) == list(range(64))
        t, work = M.allocate(fp, groups, [M.block_counts(fp, g) for g in groups], 3)
        assert (t.sum(axis=1) == 3 - m + 1).all() and (t >= -1).all() and np.isfinite(work).all()


def test_components_of_long_paths_and_stars(spark):
    rng = random.Random(3)
    nodes = list(range(400))
    rng.shuffle(nodes)
    links = list(zip(nodes[:150], nodes[1:150])) + [(nodes[200], x) for x in nodes[201:300]] + [(nodes[300], nodes[301])] * 2
    got = {r.node: r.label for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    want = {n: min(g) for g in (nodes[:150], nodes[200:300], nodes[300:302]) for n in g}
    assert got == want
    assert components(spark.createDataFrame([(1, 1)], "a long, b long")).count() == 0


def test_bits_are_grouped_by_all_fingerprints(spark):
    """Small correlations between 64 bits of 30,000 fingerprints: a sample gives other groups."""
    rng = np.random.default_rng(5)
    fp = rng.integers(0, 1 << 63, 30_000, dtype=np.int64)
    fp = np.unique(np.where(np.arange(len(fp)) % 2, fp & ~1 | (fp >> 40) & 1, fp))  # half of them: the last bit follows another
    groups, counts = M.plan(spark.createDataFrame([(int(x),) for x in fp], "fp long").repartition(5), 3)
    assert groups == M.group_bits(M.unpacked(fp.view(np.uint64)), len(groups))
    assert any({63, 23} <= set(g) for g in groups) and [c[0].sum() for c in counts] == [len(fp)] * len(groups)
