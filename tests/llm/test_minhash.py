import hashlib
import random
import re

import pytest
import xxhash
from pyspark.sql import functions as F

from platewise.llm import catalog
from platewise.llm import minhash as M

M64 = (1 << 64) - 1


def words_of(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "") or [""]


def shingles(text, words=5):
    w = words_of(text)
    return {tuple(w[i:i + words]) for i in range(max(1, len(w) - words + 1))}


def chained(*numbers):
    h = 42
    for n in numbers:
        h = xxhash.xxh64_intdigest((n & ((1 << 8 * 8) - 1)).to_bytes(8, "little"), h)
    return h


def short(n):
    return (n & 0xFFFFFFFF).to_bytes(4, "little")


def mixed(*ints):
    """xxhash64 of 32-bit numbers, chained, as a signed number."""
    h = 42
    for n in ints:
        h = xxhash.xxh64_intdigest(short(n), h)
    return h - (1 << 64) if h >> 63 else h


def brute(text, words=5, bins=256, bits=8):
    """The fingerprint by its definition: least hash per bin, probes, then ranks."""
    shift = 64 - (bins.bit_length() - 1)
    least = {}
    for s in shingles(text, words):
        h = chained(*[xxhash.xxh64_intdigest(x.encode(), 42) for x in s])
        b = ((h >> shift) + bins // 2) % bins  # in order of the signed hashes
        if h & ((1 << shift) - 1) != (1 << shift) - 1:
            least[b] = min(least.get(b, M64), h)
    low = {b: h & ((1 << bits) - 1) for b, h in least.items()}
    out = []
    for j in range(bins):
        tries = [j] + [mixed(j, t) % bins for t in range(M.PROBES)]
        hit = next((b for b in tries if b in low), None)
        out.append(low[hit] if hit is not None else min((mixed(j, c, -1), v) for c, v in low.items())[1])
    return "".join(f"{v:0{bits // 4}x}" for v in out)


def like(a, b, bits=8):
    k = bits // 4
    equal = sum(a[i:i + k] == b[i:i + k] for i in range(0, len(a), k)) * k / len(a)
    return max(0.0, (equal - 2.0 ** -bits) / (1 - 2.0 ** -bits))


def edited(text, following):
    q = len(text) // 4
    return text[:len(text) - q] + following[:q]


def expected(rows):
    rows = sorted(((i, t or "") for i, t in rows), key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode()))
    for (i, t), (_, n) in zip(rows, rows[1:] + rows[:1]):
        e = edited(t, n)
        a, b, c = brute(t), brute(e), brute(n)
        yield i, len(t), hashlib.sha256(e.encode()).hexdigest(), a, b, like(a, b), like(a, c)


def same(got, want):
    got, want = (sorted(map(tuple, x), key=str) for x in (got, want))
    assert len(got) == len(want)
    for g, w in zip(got, want):
        assert g[:5] == w[:5] and g[5:] == pytest.approx(w[5:], abs=1e-12)


def test_query_equals_brute_force(spark, sf, docs):
    got = catalog.QUERIES["op13_minhash"](spark, sf).collect()
    same(got, expected([(r.doc_id, r.text) for r in docs.collect()]))


def test_special_rows(spark, odd, odd_rows, none):
    got = M.digest(odd).collect()
    same(got, expected(odd_rows))
    prints = {}
    for r in M.fingerprint(odd).collect():
        assert prints.setdefault(r["text"] or "", bytes(r["fingerprint"])) == bytes(r["fingerprint"])
    assert M.digest(none).count() == 0 and M.fingerprint(none).count() == 0
    out = M.fingerprint(odd.withColumnRenamed("fp", "Fingerprint"))
    assert out.columns == ["doc_id", "text", "TEXT", "row", "score", "lang", "fingerprint"]
    one = M.digest(spark.createDataFrame([(7, "just one document")], "doc_id long, text string")).collect()
    same(one, expected([(7, "just one document")]))


@pytest.mark.parametrize("blocks", [1, 3, 50])
def test_next_over_any_blocks(spark, blocks):
    rng = random.Random(blocks)
    ids = [None] + rng.sample(range(-500, 500), 60) + [10 ** 12, -10 ** 12, 3, 3]
    rows = [(i, f"text {k}") for k, i in enumerate(ids)]
    out = M.with_next(spark.createDataFrame(rows, "id long, t string").repartition(5), "id", "t", blocks=blocks).collect()
    order = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1]))
    assert sorted((r.t, r.next.t) for r in out) == sorted((a[1], b[1]) for a, b in zip(order, order[1:] + order[:1]))


def test_likeness_estimates_the_share_of_common_shingles(spark):
    rng = random.Random(3)
    rows, truth = [], []
    for k in range(150):
        own = [str(rng.randint(0, 10 ** 6)) for _ in range(rng.choice([8, 30, 200, 900]))]
        cut = rng.randint(0, len(own))
        other = own[:cut] + [str(rng.randint(0, 10 ** 6)) for _ in range(len(own) - cut)]
        a, b = " ".join(own), " ".join(other)
        x, y = shingles(a), shingles(b)
        rows.append((k, a, b)), truth.append(len(x & y) / len(x | y))
    for bins, bits, most in ((256, 8, 0.035), (512, 16, 0.026)):
        d = spark.createDataFrame(rows, "k int, a string, b string")
        d = M.packed(M.packed(d, "a", "pa", bins=bins, bits=bits), "b", "pb", bins=bins, bits=bits)
        got = {r.k: r.x for r in d.select("k", M.likeness("pa", "pb", bins, bits).alias("x")).collect()}
        errors = [got[k] - t for k, t in enumerate(truth)]
        assert abs(sum(errors) / len(errors)) < 0.01 and (sum(e * e for e in errors) / len(errors)) ** 0.5 < most
    assert [r.p for r in spark.createDataFrame([(rows[0][1],)], "text string").select("text").transform(
        lambda x: M.packed(x, "text", "b", 3, 16, 16)).select(F.lower(F.hex("b")).alias("p")).collect()] == [brute(rows[0][1], 3, 16, 16)]


def test_the_plan_is_native(spark, docs):
    plan = M.digest(docs)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Arrow|Pandas", plan) and plan.count("Exchange hashpartitioning") == 1


def test_other_sizes_are_refused(spark, docs):
    for bins, bits in ((100, 8), (256, 4)):
        with pytest.raises(ValueError):
            M.fingerprint(docs, bins=bins, bits=bits)
