"""LM scoring by deleted interpolation (1).

A bigram model: P(w | v) = a(b) c(v, w) / c(v) + u(b) c(w) / N + z(b) / (V + 1), where the weights of a context v
depend on its bucket b, the logarithm of its count. Counts come from all training documents. The weights are
learned by expectation-maximisation on held-out counts: the documents of one fold of the training rows are events
whose own fold is deleted from the counts that predict them.

One pass over the texts makes blocks of about ``BLOCK_BYTES``. Each block sends its distinct n-grams with their
counts once, dealt over key ranges; a range adds up the counts of all blocks and answers every block for the
n-grams it sent. So an n-gram travels at most once a block, however often it occurs, no key is hot, and what a
task holds is bounded by its block or key range, whose number is the session's shuffle width. Blocks then know the
global counts of all their tokens, which are written once; the events' statistics are gathered as a histogram of
bounded size, from which the driver learns the weights; a last pass scores the written counts.

N-grams are identified by 64-bit hashes. Results for special input: a null or empty text is its end token alone;
repeated rows are trained on and scored each; a null doc_id counts as empty text in the split; without training
rows every token has the uniform probability; an empty table gives no rows; texts of any length are read whole.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F, types as T

from platewise.llm.common import (
    BINARY, BOOL, DOUBLE, INT, LONG, crc_mod, fields, materialise, mix, pack, pick, slices, texts_of, unpack, width,
    word_hashes,
)

FOLDS, HELD_OUT = 7, 2
#: The training fold whose documents are the events of the expectation-maximisation.
EVENTS = 3
BLOCK_BYTES = 8 << 20
#: Steps of the histogram per doubling of a count or probability.
STEPS = 4
BUCKETS = 40
_END, _BEGIN = np.uint64(0x0E4D0E4D0E4D0E4D), np.uint64(0xBE61BE61BE61BE61)
_TURN = np.uint64(0x9E3779B97F4A7C15)
_NONE = -10_000
_AT_BEGIN = -1


def tokens_of(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Token hashes (words, then the end of each text) and tokens per text."""
    h, n, *_ = word_hashes(texts)
    size = n + 1
    tok = np.full(int(size.sum()), _END, np.uint64)
    tok[np.arange(len(h)) + np.repeat(np.arange(len(n)), n)] = h
    return tok, size


def pairs_of(tok: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Bigram hashes: each token with the one before it in its text."""
    before = np.empty_like(tok)
    before[1:] = tok[:-1]
    before[np.cumsum(size) - size] = _BEGIN
    with np.errstate(over="ignore"):
        return mix(mix(before) * _TURN + tok)


def _range_of(keys: np.ndarray, ranges: int) -> np.ndarray:
    return ((keys >> np.uint64(32)) * np.uint64(ranges)) >> np.uint64(32)


def _bundle(*arrays: np.ndarray) -> bytes:
    packed = [pack(a) for a in arrays]
    return np.array([len(packed), *map(len, packed)], "<i8").tobytes() + b"".join(packed)


def _unbundle(data: bytes, *dtypes) -> list[np.ndarray]:
    n = int(np.frombuffer(data, "<i8", 1)[0])
    at, out = 8 * (n + 1), []
    for size, dtype in zip(np.frombuffer(data, "<i8", n, 8).tolist(), dtypes):
        out.append(unpack(data[at:at + size], dtype))
        at += size
    return out


def _bucket(count: np.ndarray) -> np.ndarray:
    """0 for unseen contexts, then one bucket per doubling."""
    return np.where(count > 0, 1 + np.minimum(np.log2(np.maximum(count, 1)).astype(np.int64), BUCKETS - 2), 0)


def _steps(x: np.ndarray) -> np.ndarray:
    return np.where(x > 0, np.rint(STEPS * np.log2(np.where(x > 0, x, 1))), _NONE).astype(np.int64)


_SENT = fields(dest=LONG, block=LONG, data=BINARY)


def resolved(docs: DataFrame, folds: int = FOLDS, held_out: int = HELD_OUT, events: int = EVENTS,
             block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """Blocks of documents with the training counts of all their tokens, the events' histogram and totals; written."""
    spark = docs.sparkSession
    ranges = width(spark)
    source = pick(docs, "doc_id", "text").withColumn("text", F.col("text").cast("string")) \
        .withColumn("fold", crc_mod("doc_id", folds).cast("int"))
    ids = T.ArrayType(source.schema["doc_id"].dataType)
    sent = T.StructType([*_SENT.fields, T.StructField("doc_ids", ids)])

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made, task = 0, TaskContext.get().partitionId()
        kind = None
        for whole in batches:
            kind = kind or pa.list_(whole.schema.field("doc_id").type)
            for batch in slices(whole, "text", block_bytes):
                block = (1 << 40) + (task << 20) + made
                made += 1
                tok, size = tokens_of(texts_of(batch.column("text")))
                fold = batch.column("fold").to_numpy()
                train, event = (np.repeat(f, size) for f in (fold != held_out, fold == events))
                vocabulary, at = np.unique(tok, return_inverse=True)
                parts = []
                for keys, where in ((vocabulary, at), np.unique(pairs_of(tok, size), return_inverse=True)):
                    counts = [np.bincount(where, f, len(keys)).astype(np.int64) for f in (train, event)]
                    edge = np.searchsorted(_range_of(keys, ranges), np.arange(ranges + 1, dtype=np.uint64))
                    parts.append((keys, *counts, edge))
                for r in range(ranges):
                    own = [x[e[r]:e[r + 1]] for *arrays, e in parts for x in arrays]
                    own = [np.diff(x, prepend=np.uint64(0)) if k % 3 == 0 else x for k, x in enumerate(own)]
                    if len(own[0]) or len(own[3]):
                        yield _row([r, block, _bundle(*own), None], kind)
                docs_of = batch.column("doc_id").to_pylist()
                data = _bundle(at.astype(np.uint32), vocabulary, size, fold.astype(np.int32))
                yield _row([block, block, data, docs_of], kind)

    def _row(values: list, kind: pa.DataType) -> pa.RecordBatch:
        types = [pa.int64(), pa.int64(), pa.binary(), kind]
        return pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(values, types)], names=sent.names)

    moved = source.mapInArrow(send, sent).repartition(ranges, "dest")
    answer = fields(dest=LONG, part=LONG, data=BINARY, kinds=LONG)

    def add_up(got: pa.Table) -> pa.Table:
        r = got.column("dest")[0].as_py()
        if r >= 1 << 40:
            return _answers([])
        blocks = got.column("block").to_pylist()
        read = [_unbundle(d.as_py(), np.uint64, np.int64, np.int64, np.uint64, np.int64, np.int64) for d in got.column("data")]
        out, kinds = [], 0
        for k in (0, 3):
            keys = [np.cumsum(x[k], dtype=np.uint64) for x in read]
            unique, at = np.unique(np.concatenate(keys), return_inverse=True)
            sums = [np.bincount(at, np.concatenate([x[k + j] for x in read]), len(unique)).astype(np.int64) for j in (1, 2)]
            kinds = kinds or int((sums[0] > 0).sum())
            ends = np.cumsum([len(x) for x in keys])
            out.append([[s[at[e - len(x):e]] for s in sums] for x, e in zip(keys, ends)])
        return _answers([(b, r, _bundle(*ones, *twos), None) for b, ones, twos in zip(blocks, *out)] + [(-1 - r, r, None, kinds)])

    def _answers(rows: list) -> pa.Table:
        columns = list(zip(*rows)) or [[]] * 4
        return pa.table({f.name: pa.array(c, pa.binary() if f.name == "data" else pa.int64())
                         for f, c in zip(answer.fields, columns)})

    back = moved.groupBy("dest").applyInArrow(add_up, answer)
    result = T.StructType([*fields(kind=INT, data=BINARY).fields, T.StructField("doc_ids", ids),
                           *fields(bucket=LONG, pair=LONG, single=LONG, n=LONG, pairs=DOUBLE, singles=DOUBLE, kinds=LONG,
                                   train_docs=LONG, event_docs=LONG, train_tokens=LONG, event_tokens=LONG).fields])

    def resolve(left: pa.Table, right: pa.Table) -> pa.Table:
        types = _arrow_of(left.schema.field("doc_ids").type)
        if not left.num_rows:
            return _rows([{"kind": 2, "kinds": right.column("kinds")[0].as_py()}] if right.num_rows else [], types)
        if not right.num_rows:
            return _rows([], types)
        right = right.sort_by("part")
        parts = [_unbundle(d.as_py(), *[np.int64] * 4) for d in right.column("data")]
        one, one_own, two, two_own = (np.concatenate(x) for x in zip(*parts))
        at, vocabulary, size, fold = _unbundle(left.column("data")[0].as_py(), np.uint32, np.uint64, np.int64, np.int32)
        tok = vocabulary[at]
        _, pair = np.unique(pairs_of(tok, size), return_inverse=True)
        c1, c2 = one[at], two[pair]
        rows = [{"kind": 0, "data": _bundle(c1, c2, size, fold), "doc_ids": left.column("doc_ids")[0].as_py(),
                 "train_docs": int((fold != held_out).sum()), "event_docs": int((fold == events).sum()),
                 "train_tokens": int(size[fold != held_out].sum()), "event_tokens": int(size[fold == events].sum())}]
        event = np.repeat(fold == events, size)
        if event.any():
            d1, d2 = c1 - one_own[at], c2 - two_own[pair]
            context = np.concatenate([[0], d1[:-1]])
            begin = np.zeros(len(tok), bool)
            begin[np.cumsum(size) - size] = True
            d1, d2, context, begin = d1[event], d2[event], context[event], begin[event]
            bucket = np.where(begin, _AT_BEGIN, _bucket(context))
            share = np.where(begin, d2, d2 / np.maximum(context, 1))
            cells, where = np.unique(np.column_stack([bucket, _steps(share), _steps(d1)]), axis=0, return_inverse=True)
            sums = [np.bincount(where.reshape(-1), v, len(cells)) for v in (None, share, d1)]
            rows += [{"kind": 1, "bucket": b, "pair": p, "single": s, "n": int(n), "pairs": x, "singles": y}
                     for (b, p, s), n, x, y in zip(cells.tolist(), *(s.tolist() for s in sums))]
        return _rows(rows, types)

    def _arrow_of(kind: pa.DataType) -> pa.Schema:
        by = {"kind": pa.int32(), "data": pa.binary(), "doc_ids": kind, "pairs": pa.float64(), "singles": pa.float64()}
        return pa.schema([(f.name, by.get(f.name, pa.int64())) for f in result.fields])

    def _rows(rows: list[dict], types: pa.Schema) -> pa.Table:
        return pa.Table.from_pylist([{f.name: r.get(f.name) for f in result.fields} for r in rows], schema=types)

    return materialise(moved.groupBy("dest").cogroup(back.groupBy("dest")).applyInArrow(resolve, result), "counts")


def learn(cells: np.ndarray, n: np.ndarray, pairs: np.ndarray, singles: np.ndarray, begin: int, total: int,
          kinds: int, rounds: int = 200, tol: float = 1e-7) -> np.ndarray:
    """Mixture weights (bucket, 3) by expectation-maximisation over the events' histogram.

    Each bucket's expected counts are joined by those of a few events under the weights of all buckets together,
    which decide where a bucket has no events. Unseen contexts have no bigram estimate, so no weight for it.
    """
    at = np.where(cells == _AT_BEGIN, _bucket(np.full(len(cells), begin)), cells)
    mean = np.maximum(n, 1)
    share = np.where(cells == _AT_BEGIN, pairs / mean / max(1, begin), pairs / mean)
    p = np.column_stack([share, singles / mean / max(1, total), np.full(len(n), 1 / (kinds + 1))])
    able = np.ones((BUCKETS, 3))
    able[0, 0] = 0
    weights = able / able.sum(axis=1, keepdims=True)
    if not len(n):
        weights = able * [0.3, 0.5, 0.2]
        return weights / weights.sum(axis=1, keepdims=True)
    for _ in range(rounds):
        joint = weights[at] * p
        own = n[:, None] * joint / joint.sum(axis=1, keepdims=True)
        expected = np.column_stack([np.bincount(at, own[:, k], BUCKETS) for k in range(3)])
        pooled = (expected.sum(axis=0) + 1e-3) * able
        new = expected + 5 * pooled / pooled.sum(axis=1, keepdims=True)
        new = np.maximum(new, 1e-9) * able
        new /= new.sum(axis=1, keepdims=True)
        moved = np.abs(new - weights).max()
        weights = new
        if moved < tol:
            break
    return weights


def fit(blocks: DataFrame) -> dict:
    """Totals and mixture weights; at most BUCKETS times the histogram's steps squared rows reach the driver."""
    total = blocks.agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in (
        "kinds", "train_docs", "event_docs", "train_tokens", "event_tokens")]).first().asDict()
    rows = blocks.where("kind = 1").groupBy("bucket", "pair", "single").agg(
        F.sum("n").alias("n"), F.sum("pairs").alias("pairs"), F.sum("singles").alias("singles")).toArrow()
    got = {c: rows.column(c).to_numpy() for c in ("bucket", "n", "pairs", "singles")}
    weights = learn(got["bucket"], got["n"].astype(float), got["pairs"], got["singles"],
                    total["train_docs"] - total["event_docs"], total["train_tokens"] - total["event_tokens"], total["kinds"])
    if not total["train_tokens"]:
        weights = np.tile([0.0, 0.0, 1.0], (BUCKETS, 1))
    return {**total, "weights": weights}


def score(blocks: DataFrame, model: dict, held_out: int = HELD_OUT) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score and score of every document in the blocks."""
    total, kinds, begin, weights = model["train_tokens"], model["kinds"], model["train_docs"], model["weights"]
    kind = blocks.schema["doc_ids"].dataType.elementType
    out = T.StructType([T.StructField("doc_id", kind), *fields(
        held_out=BOOL, n_tokens=LONG, n_known=LONG, train_tokens=LONG, base_score=DOUBLE, score=DOUBLE).fields])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                c1, c2, size, fold = _unbundle(batch.column("data")[i].as_py(), np.int64, np.int64, np.int64, np.int32)
                first = np.cumsum(size) - size
                context = np.concatenate([[0], c1[:-1]])
                context[first] = begin
                w = weights[_bucket(context)]
                p = w[:, 0] * c2 / np.maximum(context, 1) + w[:, 1] * c1 / max(1, total) + w[:, 2] / (kinds + 1)
                sums = [np.add.reduceat(x, first) for x in ((c1 > 0).astype(np.int64), np.log10(c1 + 1.0), np.log10(p))] \
                    if len(size) else [np.zeros(0)] * 3
                n = len(size)
                yield pa.RecordBatch.from_arrays([
                    batch.column("doc_ids").slice(i, 1).flatten(), pa.array(fold == held_out), pa.array(size),
                    pa.array(sums[0].astype(np.int64)), pa.array(np.full(n, total, np.int64)),
                    pa.array(sums[1] - size * np.log10(total + kinds + 1.0)), pa.array(sums[2])], names=out.names)

    return blocks.where("kind = 0").select("data", "doc_ids").mapInArrow(run, out)


def score_documents(docs: DataFrame) -> DataFrame:
    blocks = resolved(docs)
    return score(blocks, fit(blocks))
