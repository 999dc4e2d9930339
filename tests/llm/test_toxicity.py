import random
import zlib

import numpy as np
import pytest

from platewise.llm import toxicity as M


def corpus(n=500, seed=1):
    rng = random.Random(seed)
    plain = ["".join(rng.choice("aeiou") + rng.choice("bdlmnrst") for _ in range(rng.randint(1, 4))) for _ in range(400)]
    rows = []
    for i in range(n):
        bad = i % 6 == 0
        w = [rng.choice(plain) for _ in range(rng.choice([30, 100, 900]))]
        for _ in range(rng.randint(2, 5) if bad else 0):
            w.insert(rng.randrange(len(w)), rng.choice(["zugh", "kruxx", "zughito"]) + rng.choice(["", "a", "en", "" if i % 2 else "ur"]))
        rows.append((i, " ".join(w), int(bad)))
    return rows


def frames(spark, rows):
    docs = spark.createDataFrame([(i, t) for i, t, _ in rows], "doc_id long, text string")
    labels = spark.createDataFrame([(i, 1, y) for i, _, y in rows], "doc_id long, quality int, toxic int")
    return docs, labels


def test_held_out_documents_are_told_apart(spark):
    rows = corpus()
    docs, labels = frames(spark, rows)
    got = {r.doc_id: r for r in M.digest(docs, labels).collect()}
    held = [(got[i].predicted, y) for i, _, y in rows if got[i].held_out]
    assert all(got[i].held_out == (zlib.crc32(str(i).encode()) % 4 == 2) for i, _, _ in rows)
    assert sum(p == y for p, y in held) >= 0.95 * len(held)


def test_held_out_labels_change_nothing(spark):
    rows = corpus(200)
    docs, labels = frames(spark, rows)
    flipped = spark.createDataFrame([(i, 1, 1 - y if zlib.crc32(str(i).encode()) % 4 == 2 else y) for i, _, y in rows],
                                    "doc_id long, quality int, toxic int")
    a, b = ({r.doc_id: r.score for r in M.digest(docs, x).collect()} for x in (labels, flipped))
    assert a == b


def test_odd_rows(spark, odd, odd_rows, none):
    docs, labels = frames(spark, corpus(200))
    model = M.train(docs, labels)
    got = M.score(odd, model)
    rows = got.collect()
    assert len(rows) == len(odd_rows) and all(0 <= r.toxicity <= 1 for r in rows)
    assert got.columns == [*odd.columns, "toxicity"]
    assert M.score(none, model).count() == 0
    empty = labels.limit(0)
    assert {r.score for r in M.digest(odd, empty).collect()} == {0.5}
    only = spark.createDataFrame([(i, 1, 0) for i in range(20)], "doc_id long, quality int, toxic int")
    assert {r.score for r in M.digest(odd, only).collect()} == {0.0}
    mixed = spark.createDataFrame([(None, 1, 1), (1, None, None), (3, 1, 1), (3, 1, 0), (4, 1, 0)], "doc_id long, quality int, toxic int")
    assert M.digest(odd, mixed).count() == len(odd_rows)
    assert M.digest(none, labels).count() == 0


def brute(words, counts, order):
    """Textbook interpolated Kneser-Ney with pooled backoff: log P(word | class) for both classes."""
    grams = {}
    for c, bag in enumerate(counts):
        for w, n in bag.items():
            s = b"\x01" * (order - 1) + w + b"\x02"
            for k in range(len(s) - order + 1):
                grams.setdefault(s[k:k + order], [0, 0])[c] += n

    def discount(v):
        once, twice = sum(x == 1 for x in v), sum(x == 2 for x in v)
        return min(0.9, max(0.1, once / max(1, once + 2 * twice)))

    types = {order: set(grams)}
    cont = {}
    for k in range(order - 1, 0, -1):
        types[k] = {g[1:] for g in types[k + 1]}
        cont[k] = {}
        for g in types[k + 1]:
            cont[k][g[1:]] = cont[k].get(g[1:], 0) + 1

    def low(g):
        k = len(g)
        if k == 1:
            return (cont[1].get(g, 0) + 0.5) / (sum(cont[1].values()) + 128)
        own = {x: n for x, n in cont[k].items() if x[:-1] == g[:-1]}
        if not own:
            return low(g[1:])
        d, total = discount(cont[k].values()), sum(own.values())
        return max(own.get(g, 0) - d, 0) / total + d * len(own) / total * low(g[1:])

    out = []
    for w in words:
        s, both = b"\x01" * (order - 1) + w + b"\x02", [0.0, 0.0]
        for k in range(len(s) - order + 1):
            g = s[k:k + order]
            for c in (0, 1):
                d = discount([v[c] for v in grams.values()])
                own = {x: v[c] for x, v in grams.items() if x[:-1] == g[:-1] and v[c]}
                total = sum(own.values())
                p = max(own.get(g, 0) - d, 0) / total + d * len(own) / total * low(g[1:]) if total else low(g[1:])
                both[c] += np.log(p)
        out.append(both[0] - both[1])
    return out


@pytest.mark.parametrize("order", [3, 5])
def test_differences_equal_the_textbook(order):
    rng = random.Random(order)
    word = lambda: "".join(rng.choice("abcé") for _ in range(rng.randint(1, 5))).encode()
    bags = [{word(): rng.randint(1, 5) for _ in range(25)} for _ in range(2)]
    g, c = [], [[], []]
    for t in (0, 1):
        words = list(bags[t])
        keys, n = M.grams_of(words, order)
        g.append(keys)
        c[t].append(np.repeat([bags[t][w] for w in words], n))
        c[1 - t].append(np.zeros(len(keys), int))
    unique, a, b = M._sums(np.concatenate(g), np.concatenate([c[0][0], c[0][1]]), np.concatenate([c[1][0], c[1][1]]))
    model = M.kneser_ney(unique, a, b, order)
    seen = [w for w in list(bags[0]) + list(bags[1])]
    assert np.allclose(M.differences(model, seen), brute(seen, bags, order))
    other = [w for w in (word() for _ in range(30)) if w not in seen]
    d, want = M.differences(model, other), brute(other, bags, order)
    assert np.allclose(d, want)
