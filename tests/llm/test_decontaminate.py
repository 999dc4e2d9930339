import hashlib
import re

from platewise.llm import decontaminate as M

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))


def brute(rows, items, window=10):
    out = []
    for i, text in rows:
        w, hit, found = words(text), set(), set()
        for name, item in items:
            v = words(item)
            for k in range(max(1, len(v) - window + 1) if v else 0):
                part = v[k:k + window]
                for a in range(len(w) - len(part) + 1):
                    if w[a:a + len(part)] == part:
                        hit.update(range(a, a + len(part)))
                        found.add(str(name))
        sha = hashlib.sha256(",".join(sorted(found)).encode()).hexdigest()
        out.append((i, len(w), len(hit), len(found), sha, bool(hit)))
    return out


def same(df, rows, items):
    assert sorted(map(tuple, df.collect()), key=str) == sorted(brute(rows, items), key=str)


def test_equals_brute_force(spark, sf, docs):
    docs = docs.where("n_chars < 4000")
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    bench = spark.read.parquet(f"{sf}/benchmark.parquet")
    items = [(r.item_id, r.text) for r in bench.collect()][:15]
    bench = spark.createDataFrame(items, "item_id long, text string")
    own = [(900 + k, f"{rows[k][1]} {t}! {t.upper()}") for k, (_, t) in enumerate(items[:5])]
    df = spark.createDataFrame(rows[:60] + own, "doc_id long, text string")
    same(M.digest(M.decontaminate(df, bench)), rows[:60] + own, items)


def test_odd_rows(spark, odd, odd_rows, none):
    items = [(1, odd_rows[0][1]), (2, None), (3, ""), (4, "one"), (5, "One Two"), (5, "straße"), (10, "ß straße 漢字 ünïcode"),
             (None, "quick brown fox")]
    bench = spark.createDataFrame([(i, t, "x") for i, t in items], "item_id long, text string, n_hit string")
    want = [(("" if i is None else i), t) for i, t in items]
    same(M.digest(M.decontaminate(odd, bench)), odd_rows, want)
    same(M.digest(M.decontaminate(odd, bench.limit(0))), odd_rows, [])
    assert M.decontaminate(none, bench).count() == 0
    assert M.decontaminate(odd, bench).columns == [*odd.columns, "n_words", "n_hit", "items", "spans"]


def test_spans_are_in_the_original_text(spark):
    bench = spark.createDataFrame([(1, "the answer is forty-two"), (2, "Ünï code")], "item_id long, text string")
    text = "漢 So: THE  answer,is\nforty-TWO! And Ünï\u2028.code."
    row = M.decontaminate(spark.createDataFrame([(1, text)], "doc_id long, text string"), bench).first()
    assert [text[s.start:s.end] for s in row.spans] == ["THE  answer,is\nforty-TWO"]
    text = "x ünï... CODE y Ünï code"
    row = M.decontaminate(spark.createDataFrame([(1, text)], "doc_id long, text string"), bench).first()
    assert [text[s.start:s.end] for s in row.spans] == ["Ünï code"]


def test_large_benchmarks_take_several_automata():
    items = [(str(k), f"w{k} of item {k} and more words than ten are in it {k}".encode()) for k in range(50)]
    one, many = M.Scanner(M.windows(items)), M.Scanner(M.windows(items), most=300)
    assert len(one.automata) == 1 and len(many.automata) > 5
    text = b"x ".join(t for _, t in items[::7])
    assert one.scan(text) == many.scan(text) and one.scan(text)[2]


def test_one_automaton_is_held_at_a_time(monkeypatch):
    items = [(str(k % 9), f"w{k} of item {k} and more words than ten are in it {k} ".encode() * (1 + k)) for k in range(20)] + [("s", b"w3 of")]
    alive, most = set(), []

    class Counted:
        def __init__(self, patterns):
            self.own, self.size = make(patterns), sum(map(len, patterns))
            alive.add(id(self))
            most.append((len(alive), self.size))

        def __del__(self):
            alive.discard(id(self))

        def iter(self, line):
            return self.own.iter(line)

    make = M.automaton
    one = M.Scanner(M.windows(items))
    texts = [b"x ".join(t for _, t in items[k::7]) for k in range(7)] + [b"", b"a w3 OF b", b"clean"]
    want = [one.scan(t) for t in texts]
    monkeypatch.setattr(M, "automaton", Counted)
    parts = M.portions(items, most=3000)
    assert len(parts) > 5 and M.Scanner(parts).scan_all(texts) == want and want[0][2] and want[-2][2] == ["s"]
    assert len(most) == len(parts) and max(n for n, _ in most) == 1 and max(s for _, s in most) <= 4500
    assert M.portions([("a", b""), ("b", b"..")]) == []
