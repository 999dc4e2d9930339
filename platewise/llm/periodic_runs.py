"""Periodic runs of words by string synchronising sets (11).

A run is a maximal stretch of words with smallest period q (words q apart are identical) of at least ``FOLD`` periods
and ``LEAST`` words. Runs of a text are found in three steps, vectorised over the texts of a batch:

* Highly periodic regions of periods below ``SMALL`` come from comparing the words with themselves, shifted.
* At each dyadic scale tau from ``SMALL`` on, a position i is synchronising if the least hash of the tau-word fragments
  that start in i..i+tau stands at i or at i+tau. Whether it does depends only on the 2 tau words behind i, so equal
  contexts give equal choices. Fragments within a region of period tau/4 or less get no hash: those regions, found
  before, supply the small periods that are left out here, and the set stays sparse in them.
* Each synchronising position is paired with the next one of equal context; a distance of tau to 2 tau - 1 is proposed
  as a period there, and compared word by word to both sides.

No run is missed. Let tau be the scale with tau <= q < 2 tau. If the first tau positions of a run held no
synchronising one, its first 3 tau - 1 words would have a period of at most tau/4 beside q, and by Fine and Wilf's
theorem q would not be the smallest. A position i among them, its partner i + q and both contexts lie within 4 q words;
an equal context between them would again imply a smaller period.

Results for special input: a null, empty or blank text has no words, no runs and an empty collapsed text; repeated rows
are treated each; texts of any length are read whole; an empty table gives no rows; other columns are kept, but for
those named like the new ones.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from platewise.llm.common import LONG, STRING, carry, fields, mix, pick, restore, slices, texts_of

FOLD, LEAST, SMALL = 4, 6, 8
_NONE = np.uint64(0xFFFFFFFFFFFFFFFF)
_STEP = np.uint64(0x9E3779B97F4A7C15)


def numbered(words: list[bytes], base: int) -> tuple[np.ndarray, int]:
    """Equal words as equal numbers from ``base`` on, and the first number not used."""
    number = {w: base + k for k, w in enumerate(dict.fromkeys(words))}
    return np.fromiter(map(number.__getitem__, words), np.int64, len(words)), base + len(number)


def window_min(x: np.ndarray, width: int) -> np.ndarray:
    """The least of each ``width`` neighbours: running minima from both ends of blocks of that width."""
    n = len(x) - width + 1
    blocks = np.append(x, np.full(-len(x) % width, _NONE)).reshape(-1, width)
    ahead = np.minimum.accumulate(blocks, axis=1).ravel()
    back = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(back[:n], ahead[width - 1:width - 1 + n])


def common_start(a: np.ndarray, b: np.ndarray) -> int:
    """How many first entries are equal."""
    n, at, step = min(len(a), len(b)), 0, 64
    while at < n:
        end = min(n, at + step)
        other = np.flatnonzero(a[at:end] != b[at:end])
        if len(other):
            return at + int(other[0])
        at, step = end, 2 * step
    return n


def proposals(h: np.ndarray, context: np.ndarray, tau: int) -> list[tuple[int, int]]:
    """(position, period) for pairs of synchronising positions; one for the pairs of a stretch."""
    least = window_min(h, tau + 1)
    chosen = np.flatnonzero(((least == h[:-tau]) | (least == h[tau:])) & (least != _NONE))
    order = np.argsort(context[chosen], kind="stable")
    at, key = chosen[order], context[chosen[order]]
    same = key[1:] == key[:-1]
    i, d = at[:-1][same], (at[1:] - at[:-1])[same]
    fits = (d >= tau) & (d < 2 * tau)
    order = np.lexsort((i[fits], d[fits]))
    i, d = i[fits][order], d[fits][order]
    head = np.ones(len(i), dtype=bool)  # equal periods at positions within 2 tau belong to one stretch
    head[1:] = (d[1:] != d[:-1]) | (i[1:] - i[:-1] > 2 * tau)
    return list(zip(i[head].tolist(), d[head].tolist()))


def stretches(ids: np.ndarray, sizes: list[int], fold: int = FOLD) -> list[tuple[int, int, int]]:
    """(start, end, period) of all maximal stretches of at least ``fold`` (4 or more) periods, in order.

    ``ids`` are the numbered words of texts of these ``sizes``, longest first; no two texts share a number."""
    if fold < 4:
        raise ValueError("synchronising sets at dyadic scales need four periods or more")
    found: dict[tuple[int, int], int] = {}  # periods come in ascending order, so the smallest one stays
    for q in range(1, SMALL):
        same = np.flatnonzero(ids[q:] == ids[:-q])
        cut = np.flatnonzero(np.diff(same) > 1)
        first = same[np.append(0, cut + 1)] if len(same) else same
        last = same[np.append(cut, len(same) - 1)] if len(same) else same
        long = last - first + 1 >= (fold - 1) * q
        for s, e in zip(first[long].tolist(), (last[long] + 1 + q).tolist()):
            found.setdefault((s, e), q)
    tau, h = 1, mix(ids.astype(np.uint64) * _STEP)  # hashes of the tau words from each position on
    ends, sizes = np.cumsum(sizes), np.asarray(sizes)
    while (deep := int(np.searchsorted(-sizes, -4 * tau, side="right"))) > 0:
        n = int(ends[deep - 1])  # texts of 4 tau words and more
        h = h[:n - tau + 1]
        context = mix(h[:-tau] * _STEP + h[tau:])
        if tau >= SMALL:
            sparse = h.copy()
            for (s, e), q in found.items():
                if 4 * q <= tau <= e - s:
                    sparse[s:e - tau + 1] = _NONE
            for i, d in proposals(sparse, context, tau):
                end = i + d + common_start(ids[i:n - d], ids[i + d:n])
                start = i - common_start(ids[:i][::-1], ids[d:i + d][::-1])
                if end - start >= fold * d:
                    found.setdefault((start, end), d)
        tau, h = 2 * tau, context
    return sorted((s, e, q) for (s, e), q in found.items())


def runs_of(texts: list[bytes], fold: int = FOLD, least: int = LEAST) -> tuple[list[list[dict]], list[bytes]]:
    """Each text's runs in order of start, then period, and its words without the repeats, joined by spaces."""
    split = [t.split() for t in texts]  # ASCII spaces \x09-\x0D and \x20
    order = sorted(range(len(texts)), key=lambda k: -len(split[k]))
    ids, base = [], 0
    for k in order:
        own, base = numbered(split[k], base)
        ids.append(own)
    runs: list[list[dict]] = [[] for _ in texts]
    starts = np.cumsum([0] + [len(i) for i in ids])
    for s, e, q in stretches(np.concatenate(ids) if ids else np.empty(0, np.int64), [len(i) for i in ids], fold):
        if e - s >= least:
            k = int(np.searchsorted(starts, s, side="right")) - 1
            runs[order[k]].append({"start": s - int(starts[k]), "length": e - s, "period": q})
    kept = []
    for words, found in zip(split, runs):
        if found:
            keep = np.ones(len(words), dtype=bool)
            for r in found:
                keep[r["start"] + r["period"]:r["start"] + r["length"]] = False
            words = [words[i] for i in np.flatnonzero(keep).tolist()]
        kept.append(b" ".join(words))
    return runs, kept


RUN = fields(start=LONG, length=LONG, period=LONG)


def find_runs(docs: DataFrame, fold: int = FOLD, least: int = LEAST) -> DataFrame:
    """``docs`` with ``runs`` (start and length in words, period) and ``collapsed``: the text's words, joined by single
    spaces, without those that any run holds after its first period."""
    source = carry(docs, "text").withColumn("text", F.col("text").cast("string"))
    schema = T.StructType([source.schema["row"], T.StructField("runs", T.ArrayType(RUN)), T.StructField("collapsed", STRING)])
    kind = pa.list_(pa.struct([(f, pa.int64()) for f in RUN.names]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole, "text"):
                runs, kept = runs_of(texts_of(batch.column("text")), fold, least)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("row"), pa.array(runs, kind), pa.array(kept, pa.binary()).cast(pa.string())], names=schema.names)

    return restore(source.mapInArrow(run, schema), docs, "runs", "collapsed")


def with_loops(docs: DataFrame) -> DataFrame:
    """``doc_id`` and ``text``, where every tenth text (by crc32 of its id) ends in a loop of some of its words."""
    source = pick(docs, "doc_id", "text").withColumn("text", F.col("text").cast("string")).withColumn(
        "h", F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")))

    def loop(words: list[bytes], g: int) -> bytes:
        a = g % len(words)
        p = 1 + (len(words) - a) // (3 + g % 8)
        body = words[a:a + p]
        left = len(words) - a
        return b" ".join(words[:a] + (body * (left // p + 1))[:left])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, hashes = batch.column("text").cast(pa.binary()).to_pylist(), batch.column("h").to_pylist()
            new = [loop(t.split(), h // 10) if h % 10 == 0 and t and t.split() else t for t, h in zip(texts, hashes)]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(new, pa.binary()).cast(pa.string())],
                                             names=["doc_id", "text"])

    return source.mapInArrow(run, T.StructType([source.schema["doc_id"], source.schema["text"]]))


def digest(found: DataFrame) -> DataFrame:
    """The operator's rows as the registered query returns them."""
    number = lambda x, f: x[f].cast("string")
    lines = F.array_join(F.transform("runs", lambda x: F.concat(number(x, "start"), F.lit(","), number(x, "length"), F.lit(","),
                                                                number(x, "period"), F.lit("\n"))), "")
    # fractions compared as whole numbers; runs are in order, so the first of equal ones stays
    best = F.aggregate("runs", F.lit(None).cast(RUN), lambda b, x: F.when(
        b.isNull() | (x["length"] * b["period"] > b["length"] * x["period"]), x).otherwise(b))
    sha = lambda c: F.sha2(c.cast("binary"), 256)
    return found.select("doc_id", F.size("runs").cast("long").alias("n_runs"), best.alias("best"),
                        sha(lines).alias("runs_sha256"), sha(F.col("collapsed")).alias("collapsed_sha256")).select(
        "doc_id", "n_runs", "best.start", "best.length", "best.period",
        F.expr("1000 * best.length div best.period").alias("exponent_milli"),
        "runs_sha256", "collapsed_sha256")


def document_runs(docs: DataFrame) -> DataFrame:
    return digest(find_runs(with_loops(docs)))
