"""Benchmark decontamination (5): one Aho-Corasick automaton over normalised benchmark windows.

Texts are normalised to A-Z lower-cased words joined by single spaces, where a word is a run of digits,
letters a-z or non-ASCII characters. Every window of ``window`` consecutive item words (a shorter item is one
window) is a pattern, framed by spaces so that it matches whole words only. Each text is scanned once;
matches are mapped back to word numbers and, on request, to character offsets in the original text.

Results for special input: a null or empty text has no words and is clean; a null or empty item has no window;
repeated items each count; an empty benchmark leaves every document clean; very long texts are scanned whole.
The benchmark is small by nature. Its size is checked: one automaton holds at most ``AUTOMATON_BYTES`` of
patterns, and a larger benchmark is scanned by several automata with the same result. A task builds them one after the
other for each group of texts, from the benchmark's normalised text, and holds one at a time.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from platewise.llm.common import LONG, STRING, carry, fields, pick, restore, slices, texts_of

WINDOW = 10
#: Bytes of patterns in one automaton (about 50 times as much memory).
AUTOMATON_BYTES = 4 << 20
#: Bytes of text that each of several automata scans before the next one is built.
GROUP_BYTES = 64 << 20
#: Bytes of benchmark text that may go to the driver and the executors; a task holds it and one automaton.
BENCHMARK_BYTES = 256 << 20
_FOLD = bytes(c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else c + 32 if 65 <= c <= 90 else 32
              for c in range(256))
_WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def normalise(text: bytes) -> list[bytes]:
    """The words of a UTF-8 text: A-Z lower-cased runs of ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]``."""
    return text.translate(_FOLD).split()


def windows(items: list[tuple[str, bytes]], window: int = WINDOW) -> dict[str, set[str]]:
    """Pattern (words framed by spaces, as Latin-1) -> ids of the items that hold it."""
    found: dict[str, set[str]] = {}
    for item, text in items:
        words = normalise(text)
        for k in range(max(1, len(words) - window + 1)) if words else ():
            key = (b" " + b" ".join(words[k:k + window]) + b" ").decode("latin-1")
            found.setdefault(key, set()).add(item)
    return found


def portions(items: list[tuple[str, bytes]], window: int = WINDOW, most: int = AUTOMATON_BYTES) -> list[list[tuple[str, bytes]]]:
    """The items' normalised texts in portions whose windows take at most about ``most`` bytes; long texts are cut, with
    the overlap that keeps all their windows."""
    out, size = [], most + 1
    step = max(1, most // (16 * window))
    for item, text in items:
        words = normalise(text)
        for k in range(0, max(1, len(words) - window + 1), step) if words else ():
            own = b" ".join(words[k:k + step + window - 1])
            if size + window * len(own) > most:
                out.append([])
                size = 0
            out[-1].append((item, own))
            size += window * len(own)
    return out


def automaton(patterns: dict[str, set[str]]):
    out = ahocorasick.Automaton()
    for key in sorted(patterns):
        out.add_word(key, (len(key), tuple(sorted(patterns[key]))))
    out.make_automaton()
    return out


class Scanner:
    """Scans texts in a Python worker with one automaton at a time: the only one is built once, of several each is built
    for every group of texts and given up before the next. Takes ``windows``, or ``portions`` of items."""

    def __init__(self, patterns: dict[str, set[str]] | list[list[tuple[str, bytes]]], most: int = AUTOMATON_BYTES,
                 window: int = WINDOW):
        self.window, self.built = window, None
        self.automata = patterns if isinstance(patterns, list) else []
        if isinstance(patterns, dict):
            size = most + 1
            for key in sorted(patterns):
                if size + len(key) > most:
                    self.automata.append({})
                    size = 0
                self.automata[-1][key] = patterns[key]
                size += len(key)

    def each(self) -> Iterator:
        for part in self.automata:
            if self.built is None:
                self.built = automaton(part if isinstance(part, dict) else windows(part, self.window))
            yield self.built
            if len(self.automata) > 1:
                self.built = None

    def scan(self, text: bytes) -> tuple[int, list[tuple[int, int]], list[str]]:
        """Number of words, hit word ranges [first, last), ids of the items found."""
        return self.scan_all([text])[0]

    def scan_all(self, texts: list[bytes]) -> list[tuple[int, list[tuple[int, int]], list[str]]]:
        """``scan`` of each text."""
        lines = [(b" " + b" ".join(normalise(t)) + b" ").decode("latin-1") for t in texts]
        found: dict[int, tuple[set, set]] = {}
        for a in self.each():
            for i, line in enumerate(lines):
                for end, (size, ids) in a.iter(line):
                    spans, items = found.setdefault(i, (set(), set()))
                    spans.add((end - size + 1, end))
                    items.update(ids)
            del a
        return [self._merged(line, *found.get(i, ((), ()))) for i, line in enumerate(lines)]

    @staticmethod
    def _merged(line: str, found, items) -> tuple[int, list[tuple[int, int]], list[str]]:
        n = line.count(" ") - 1 if len(line) > 2 else 0
        if not found:
            return n, [], []
        words = line.split(" ")[1:-1]
        at = np.cumsum([0] + [len(w) + 1 for w in words])  # the space before each word
        spans = np.searchsorted(at, np.array(sorted(found)))
        merged: list[list[int]] = []
        for a, b in spans.tolist():
            if merged and a <= merged[-1][1]:
                merged[-1][1] = max(merged[-1][1], b)
            else:
                merged.append([a, b])
        return len(words), [(a, b) for a, b in merged], sorted(items)


def offsets(text: str, spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Word ranges as character ranges [start, end) of the original text."""
    if not spans:
        return []
    at = [m.span() for m in _WORD.finditer(text.translate(_LOWER))]
    return [(at[a][0], at[b - 1][1]) for a, b in spans]


_LOWER = {c: c + 32 for c in range(65, 91)}
OUT = fields(n_words=LONG, n_hit=LONG, items=T.ArrayType(STRING), spans=T.ArrayType(fields(start=LONG, end=LONG)))


def benchmark_items(benchmark: DataFrame, most: int = BENCHMARK_BYTES) -> list[tuple[str, bytes]]:
    """(id as string, text) of the items that have a text; refuses more than ``most`` bytes."""
    items = pick(benchmark, "item_id", "text").where("text is not null").select(
        F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("item_id"), F.col("text").cast("binary").alias("t"))
    size = items.agg(F.sum(F.length("t"))).first()[0] or 0
    if size > most:
        raise ValueError(f"benchmark of {size} bytes; at most {most} are held in memory")
    return [(r[0], bytes(r[1])) for r in items.collect()]


def decontaminate(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, with_spans: bool = True) -> DataFrame:
    """``docs`` with n_words, n_hit, items (ids found, sorted as strings) and spans (character ranges of the
    original text that lie in benchmark windows); columns of these names are replaced."""
    spark = docs.sparkSession
    patterns = spark.sparkContext.broadcast(portions(benchmark_items(benchmark), window))
    source = carry(docs, "text").withColumn("text", F.col("text").cast("string"))
    schema = T.StructType([source.schema["row"], *OUT.fields])

    def groups(batches: Iterator[pa.RecordBatch]) -> Iterator[list[pa.RecordBatch]]:
        least = GROUP_BYTES if len(patterns.value) > 1 else 0
        held, size = [], 0
        for batch in batches:
            held.append(batch)
            size += batch.column("text").nbytes
            if size >= least:
                yield held
                held, size = [], 0
        if held:
            yield held

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = Scanner(patterns.value, window=window)
        for group in groups(x for whole in batches for x in slices(whole, "text")):
            texts = [t for batch in group for t in texts_of(batch.column("text"))]
            hits, at = scanner.scan_all(texts), 0
            for batch in group:
                got = hits[at:at + batch.num_rows]
                at += batch.num_rows
                span = [[{"start": a, "end": b} for a, b in offsets(batch.column("text")[i].as_py(), s)]
                        if s and with_spans else [] for i, (_, s, _) in enumerate(got)]
                yield pa.RecordBatch.from_arrays([
                    batch.column("row"), pa.array([n for n, _, _ in got], pa.int64()),
                    pa.array([sum(b - a for a, b in s) for _, s, _ in got], pa.int64()),
                    pa.array([i for _, _, i in got], pa.list_(pa.string())),
                    pa.array(span, pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))),
                ], names=["row", *OUT.names])

    return restore(source.mapInArrow(scan, schema), docs, *OUT.names)


def digest(found: DataFrame) -> DataFrame:
    """The operator's rows as the registered query returns them."""
    return found.select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", "items").cast("binary"), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"))


def oracle_sql(window: int = WINDOW) -> str:
    """The registered query in SQL: every run of words joined with every benchmark window."""
    words = ("regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), "
             r"'[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')")
    return f"""
WITH d AS (SELECT row_number() OVER () AS k, doc_id, {words} AS ws FROM documents),
b AS (SELECT coalesce(CAST(item_id AS VARCHAR), '') AS item, {words} AS ws FROM benchmark),
bw AS (SELECT DISTINCT item, least({window}, len(ws)) AS size, array_to_string(ws[i:i + least({window}, len(ws)) - 1], ' ') AS gram
       FROM (SELECT item, ws, unnest(range(1, greatest(2, len(ws) - {window - 2}))) AS i FROM b WHERE len(ws) > 0) x),
g AS (SELECT k, i, size, array_to_string(ws[i:i + size - 1], ' ') AS gram
      FROM (SELECT k, ws, size, unnest(range(1, len(ws) - size + 2)) AS i
            FROM d JOIN (SELECT DISTINCT size FROM bw) s ON len(ws) >= size) x),
h AS (SELECT DISTINCT g.k, g.i, g.size, bw.item FROM g JOIN bw ON g.gram = bw.gram),
n AS (SELECT k, count(DISTINCT p) AS n_hit FROM (SELECT k, unnest(range(i, i + size)) AS p FROM h) x GROUP BY k),
s AS (SELECT k, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS ids FROM (SELECT DISTINCT k, item FROM h) x GROUP BY k)
SELECT doc_id, CAST(len(ws) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN n ON d.k = n.k LEFT JOIN s ON d.k = s.k"""
