import hashlib
import itertools
import random
import re
import zlib

import pytest

from platewise.llm import catalog
from platewise.llm import turn_repair as M

COLUMNS = "conv_id long, turn long, role string, text string"
ROLES = ["user", "assistant", "system", "tool", "", "unknown", None]
TEXTS = ["Hello there.", "Well!", "cut off", "", " \t", None, "Why?", "the end.  "]


def damage(rows):
    """conv_id -> its rows after damage, in order."""
    out = {}
    for c, t, role, text in rows:
        h = zlib.crc32(f"{' ' if c is None else c}:{' ' if t is None else t}".encode()) % 20
        role, text = (" " if x is None else x for x in (role, text))
        text = "" if h == 1 else re.sub("[.!?]", "", text) if h == 2 else text
        out.setdefault(c, []).extend([(t, "user" if h == 4 else role, text)] * (0 if h == 0 else 2 if h == 3 else 1))
    sha = lambda s: hashlib.sha256(s.encode()).digest()
    return {c: sorted(r, key=lambda x: (x[0] is not None, x[0] or 0, x[1], sha(x[2]))) for c, r in out.items()}


def faults(rows):
    seen, out = set(), []
    for _, role, text in rows:
        s = text.strip(" \t\n\x0b\x0c\r")
        out.append("blank" if not s else "duplicate" if (role, text) in seen else "truncated" if s[-1] not in ".!?" else None)
        seen.add((role, text))
    return out


def best(rows):
    """Least (cost, audit, repaired turns) by dynamic programming forward over whole audits."""
    bad = faults(rows)
    # equal costs compare by whole audits, so every start of an audit is kept that could still win
    fronts = {0: [(0, "", ())]}

    def closure(fr):
        for _ in range(3):
            for x, items in list(fr.items()):
                y, role = (3, "assistant") if x == 2 else (2, "user")
                for c, a, t in items:
                    new = (c + 2, a + "I", t + ((role, ""),))
                    if new not in fr.setdefault(y, []):
                        fr[y].append(new)
        return prune(fr)

    def prune(fr):
        out = {}
        for x, items in fr.items():
            low = min(c for c, _, _ in items)
            items = [i for i in items if i[0] == low]  # the rest of the audit is the same for all in one state
            out[x] = sorted(items, key=lambda i: i[1])
            # an audit that is a start of another one may still win or lose by what follows: keep all
            out[x] = out[x][:1] + [i for i in out[x][1:] if i[1].startswith(out[x][0][1])]
        return out

    fronts = closure(fronts)
    for (_, role, text), b in zip(rows, bad):
        new = {}
        for x, items in fronts.items():
            for c, a, t in items:
                new.setdefault(x, []).append((c + 3, a + "D", t))
                if b in ("blank", "duplicate"):
                    continue
                late, i = int(b == "truncated"), role[:1]
                y = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (2, "a"): 3, (3, "u"): 2}.get((x, i))
                if y is not None:
                    new.setdefault(y, []).append((c + late, a + "K", t + ((role, text),)))
                z, name = (3, "assistant") if x == 2 else (2, "user")
                new.setdefault(z, []).append((c + 2 + late, a + "R", t + ((name, text),)))
        fronts = closure(prune(new))
    return min(i for x in (0, 3) for i in fronts.get(x, []))


def expected(rows):
    after = damage(rows)
    for c in {r[0] for r in rows}:
        own = after.get(c, [])
        turns = [t for t, _, _ in own if t is not None]
        bad = faults(own)
        first = [r[:1] for _, r, _ in own]
        cost, audit, kept = best(own)
        yield (c, max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0, bad.count("blank"), bad.count("duplicate"),
               bad.count("truncated"), sum(a + b not in ("su", "ua", "au") for a, b in zip(first, first[1:])), cost, audit,
               hashlib.sha256("\n".join(f"{r}:{t}" for r, t in kept).encode()).hexdigest())


def same(got, want):
    got, want = (sorted(map(tuple, x), key=str) for x in (got, want))
    assert len(got) == len(want)
    for g, w in zip(got, want):
        assert g == w


def talks(rng, n, longest=14):
    rows = []
    for c in range(n):
        for t in range(rng.randint(0, longest)):
            turn = t if rng.random() < 0.9 else rng.choice([None, t - 1, t + 3])
            role = ("user", "assistant")[t % 2] if rng.random() < 0.6 else rng.choice(ROLES)
            rows.append((c if c else None, turn, role, rng.choice(TEXTS) if rng.random() < 0.5 else f"text {rng.randint(0, 99)}."))
    return rows


def test_least_audit_of_all_edits():
    """The brute force itself against all lists of edits of short conversations."""
    rng = random.Random(2)

    def every(rows, bad, x, room):
        if not rows and x in (0, 3):
            yield 0, "", ()
        z, name = (3, "assistant") if x == 2 else (2, "user")
        if room:
            for c, a, t in every(rows, bad, z, room - 1):
                yield c + 2, "I" + a, ((name, ""),) + t
        if rows:
            (_, role, text), rest = rows[0], rows[1:]
            for c, a, t in every(rest, bad[1:], x, room):
                yield c + 3, "D" + a, t
            if bad[0] not in ("blank", "duplicate"):
                late = int(bad[0] == "truncated")
                y = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (2, "a"): 3, (3, "u"): 2}.get((x, role[:1]))
                for c, a, t in (every(rest, bad[1:], y, room) if y is not None else ()):
                    yield c + late, "K" + a, ((role, text),) + t
                for c, a, t in every(rest, bad[1:], z, room):
                    yield c + 2 + late, "R" + a, ((name, text),) + t

    for _ in range(150):
        rows = [(k, rng.choice(["user", "assistant", "system", "tool"]), rng.choice(["a.", "b.", "c", ""])) for k in range(rng.randint(0, 4))]
        want = min(every(rows, faults(rows), 0, 4))
        assert best(rows) == want
        codes = "".join(M.code_of(r, t, b != "duplicate") for (_, r, t), b in zip(rows, faults(rows)))
        audit, x, cost = M.trace(codes, M.backward(codes, M.END), 0, True)
        assert (cost, audit) == want[:2] and x in (0, 3)


def test_passes_stop_where_vectors_differ_by_a_constant():
    rng = random.Random(4)
    codes = "".join(rng.choice("sua-") + rng.choice("...tbD") for _ in range(500))
    for end in {M.backward(codes, e)[:4] for e in ("0420", "2400", "0200", "3510")} | {"0420", "2402"}:
        known = M.backward(codes, "0420")
        assert M.backward(codes, end, known) == M.backward(codes, end)
    ranks = [next(i for i in reversed(range(501)) if M.backward(codes, a)[4 * i:4 * i + 4] == M.backward(codes, b)[4 * i:4 * i + 4])
             for a, b in itertools.combinations(("0420", "2402", "3510"), 2)]
    assert min(ranks) > 400  # vectors converge within a few turns


@pytest.mark.parametrize("seed,size", [(1, 1024), (2, 3)])
def test_repair_equals_brute_force_however_it_is_cut(spark, seed, size):
    rows = talks(random.Random(seed), 60) + [(1000, t, ("user", "assistant")[t % 2], f"turn {t % 50}.") for t in range(300)]
    source = spark.createDataFrame(rows, COLUMNS).repartition(4)
    found = M.summary(M.repair(M.damaged(source), size=size)).collect()
    want = {w[0]: w for w in expected(rows)}
    assert len(found) == len({c for c, r in damage(rows).items() if r})
    for r in found:
        w = want[r.conv_id]
        assert (r.blank, r.duplicate, r.truncated, r.illegal, r.cost, r.audit, r.repaired_sha256) == w[2:], r.conv_id


def test_one_conversation_and_one_turn_hold_most_rows(spark):
    rows = [(5, 1, "user", "again and again.")] * 700 + [(5, t, "assistant", f"{t}.") for t in range(2, 40)] + talks(random.Random(9), 20)
    same(M.digest(spark.createDataFrame(rows, COLUMNS)).collect(), expected(rows))
    pieces = M.repair(M.damaged(spark.createDataFrame(rows, COLUMNS))).where("conv_id = 5")
    assert pieces.count() > 1  # the turns of one conversation lie in several tasks


def test_query_equals_brute_force(spark, sf):
    rows = [tuple(r) for r in spark.read.parquet(f"{sf}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    same(catalog.QUERIES["op12_turn_repair"](spark, sf).collect(), expected(rows))


def test_special_tables(spark):
    schema = "conv_id string, turn int, role string, text string, id long, ROLE string, piece int"
    rows = [("a", 1, "user", "x" * 3_000_000 + ".", 1, "r", 0), ("a", 2, "assistant", "y" * 3_000_000 + ".", 1, "r", 0),
            (None, None, None, None, None, None, None), ("b", None, "user", "hi.", 1, "r", 0), ("b", None, "user", "hi.", 1, "r", 0)]
    got = M.digest(spark.createDataFrame(rows, schema)).collect()
    same(got, expected([r[:4] for r in rows]))
    assert M.digest(spark.createDataFrame([], schema)).count() == 0
    assert M.repaired_turns(M.repair(spark.createDataFrame([], schema))).count() == 0
    turns = M.repaired_turns(M.repair(spark.createDataFrame([("c", 1, "assistant", "Yes.")], COLUMNS.replace("conv_id long", "conv_id string"))))
    assert [tuple(r)[2:] for r in turns.orderBy("place").collect()] == [(0, "user", ""), (1, "assistant", "Yes.")]
