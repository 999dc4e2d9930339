"""Toxicity by class-conditional Kneser-Ney models (8).

Two models of words as byte sequences, one of toxic and one of ordinary documents. Each is interpolated
Kneser-Ney of ``ORDER`` bytes: class counts at the highest order, and below it backoff distributions from
continuation counts pooled over both classes, so that rare expressions of one class are smoothed by shared counts
and an inflected or unseen word still counts by its parts. A document's toxic and ordinary log-likelihoods are
compared per word: over the whole text, and over its most suspicious run of ``RUN`` words, so that a long text
does not thin out what a passage says. A word counts where it first occurs in its text, so that repetition adds
nothing. A logistic curve over these length-normalised differences, fitted on
labelled rows that the models have not seen, makes the score.

Training sample: of the labelled rows that may be learnt from, the ``per_class`` rows of each label with the
smallest hash of doc_id (documented bound; whole texts). Their n-gram counts are gathered by Spark; the model that
goes to the executors is bounded by the sample.

Results for special input: null and empty texts score like any text without words; without labelled rows of both
classes every score is the share of toxic labels (0.5 without labels); several labels of one document count as
their maximum, null labels and null ids as none; repeated rows each get a row.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from platewise.llm.common import (
    DOUBLE, INT, LONG, carry, fields, pick, restore, slices, texts_of, word_hashes,
)

ORDER = 5
RUN = 16
PER_CLASS = 10_000
THRESHOLD = 0.3
FOLDS, HELD_OUT = 4, 2
_START, _END = b"\x01", b"\x02"


def grams_of(words: list[bytes], order: int = ORDER) -> tuple[np.ndarray, np.ndarray]:
    """All byte n-grams of framed words as numbers (first byte lowest), and how many each word has."""
    joined = b"".join([_START * (order - 1) + w + _END for w in words])
    buf = np.frombuffer(joined + b"\0" * 8, np.uint8)
    n = np.fromiter(map(len, words), np.int64, len(words)) + 1
    total = n + order - 1
    first = np.cumsum(total) - total
    at = np.repeat(first - (np.cumsum(n) - n), n) + np.arange(n.sum())
    eight = np.ndarray(shape=(len(buf) - 7,), dtype="<u8", buffer=buf.data, strides=(1,))
    return eight[at] & np.uint64((1 << 8 * order) - 1), n


def _sums(keys: np.ndarray, *values: np.ndarray) -> tuple[np.ndarray, ...]:
    unique, at = np.unique(keys, return_inverse=True)
    return (unique, *[np.bincount(at, v, len(unique)) for v in values])


def _discount(n: np.ndarray) -> float:
    once, twice = (n == 1).sum(), (n == 2).sum()
    return float(np.clip(once / max(1, once + 2 * twice), 0.1, 0.9))


def _shared(grams: np.ndarray, order: int) -> np.ndarray:
    """Pooled Kneser-Ney probability of each n-gram's last byte after all but the first byte of its context."""
    chain, types = [], grams  # types: distinct (k + 1)-grams; dropping the first byte gives k-grams
    for k in range(order - 1, 0, -1):
        types, n = np.unique(types >> np.uint64(8), return_counts=True)
        chain.append((k, types, n.astype(float)))
    p = lower = None
    for k, keys, n in reversed(chain):  # unigrams first
        if p is None:
            p = (n + 0.5) / (n.sum() + 0.5 * 256)
        else:
            d = _discount(n)
            _, at = np.unique(keys & np.uint64((1 << 8 * (k - 1)) - 1), return_inverse=True)
            total, kinds = np.bincount(at, n), np.bincount(at)
            below = p[np.searchsorted(lower, keys >> np.uint64(8))]
            p = np.maximum(n - d, 0) / total[at] + (d * kinds / total)[at] * below
        lower = keys
    return p[np.searchsorted(lower, grams >> np.uint64(8))]


def kneser_ney(grams: np.ndarray, toxic: np.ndarray, ordinary: np.ndarray, order: int = ORDER) -> dict:
    """Two class models over n-grams of the highest order with their counts per class.

    Only differences are kept: for a seen n-gram the difference of its log probabilities, for a seen context that
    of its backoff weights. An unseen n-gram has the same shared backoff probability in both classes, which cancels.
    """
    by = np.argsort(grams)
    grams = grams[by]
    low = _shared(grams, order)
    contexts, at = np.unique(grams & np.uint64((1 << 8 * (order - 1)) - 1), return_inverse=True)
    logs, weights = [], []
    for c in (toxic[by].astype(float), ordinary[by].astype(float)):
        d = _discount(c)
        total = np.bincount(at, c, len(contexts))
        kinds = np.bincount(at, c > 0, len(contexts))
        weight = np.where(total > 0, d * kinds / np.maximum(total, 1), 1.0)
        logs.append(np.log(np.maximum(c - d, 0) / np.maximum(total, 1)[at] + weight[at] * low))
        weights.append(np.log(weight))
    return {"order": order, "grams": grams, "contexts": contexts, "seen": logs[0] - logs[1],
            "unseen": weights[0] - weights[1]}


def differences(model: dict, words: list[bytes]) -> np.ndarray:
    """log P(word | toxic) - log P(word | ordinary) of each word."""
    order, grams, contexts = model["order"], model["grams"], model["contexts"]
    if not words or not len(grams):
        return np.zeros(len(words))
    g, n = grams_of(words, order)
    h = g & np.uint64((1 << 8 * (order - 1)) - 1)
    i = np.minimum(np.searchsorted(grams, g), len(grams) - 1)
    j = np.minimum(np.searchsorted(contexts, h), len(contexts) - 1)
    d = np.where(grams[i] == g, model["seen"][i], np.where(contexts[j] == h, model["unseen"][j], 0.0))
    return np.add.reduceat(d, np.cumsum(n) - n)


def unique_words(texts: list[bytes]) -> tuple[list[bytes], np.ndarray, np.ndarray]:
    """Distinct words, each word's place among them, and the number of words per text."""
    h, n, joined, starts, ends = word_hashes(texts)
    _, first, at = np.unique(h, return_index=True, return_inverse=True)
    return [joined[a:b] for a, b in zip(starts[first].tolist(), ends[first].tolist())], at, n


def features(texts: list[bytes], model: dict, run: int = RUN) -> np.ndarray:
    """Per text: difference per distinct word, per word over the highest run, and the log of its length."""
    words, at, n = unique_words(texts)
    d = differences(model, words)[at] if words else np.zeros(0)
    doc = np.repeat(np.arange(len(texts)), n)
    _, new = np.unique(doc * max(1, len(words)) + at, return_index=True)
    once = np.zeros(len(d))
    once[new] = 1
    d, kinds = d * once, np.bincount(doc, once, len(texts))
    out = np.zeros((len(texts), 3))
    has = np.flatnonzero(n)
    if len(has):
        end = np.cumsum(n[has])
        first = end - n[has]
        out[has, 0] = np.add.reduceat(d, first) / kinds[has]
        total = np.concatenate([[0.0], np.cumsum(d)])
        i = np.arange(len(d))
        stop = np.minimum(i + run, np.repeat(end, n[has]))
        out[has, 1] = np.maximum.reduceat((total[stop] - total[i]) / run, first)
        out[has, 2] = np.log1p(n[has])
    return out


def logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray, ridge: float = 1e-2, steps: int = 50) -> np.ndarray:
    """Weights of a logistic regression (bias first), by Newton steps."""
    z = np.column_stack([np.ones(len(x)), x])
    b = np.zeros(z.shape[1])
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(z @ b, -30, 30)))
        w = weight * np.maximum(p * (1 - p), 1e-6)
        step = np.linalg.solve((z * w[:, None]).T @ z + ridge * np.eye(len(b)), z.T @ (weight * (y - p)) - ridge * b)
        b += step
        if np.abs(step).max() < 1e-8:
            break
    return b


def allowed(folds: int = FOLDS, held_out: int = HELD_OUT):
    """Whether a row's label may be learnt from."""
    return F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(folds)) != held_out


def train(docs: DataFrame, labels: DataFrame, per_class: int = PER_CLASS, order: int = ORDER) -> dict:
    """The fitted model: models, curve and the share of toxic labels."""
    spark = docs.sparkSession
    known = pick(labels, "doc_id", "toxic").where("doc_id is not null and toxic is not null").where(allowed()) \
        .groupBy("doc_id").agg(F.max(F.col("toxic").cast("int")).alias("toxic"))
    share = {r[0]: r[1] for r in known.where("toxic in (0, 1)").groupBy("toxic").count().collect()}
    prior = share.get(1, 0) / max(1, sum(share.values())) if share else 0.5
    if len(share) < 2:
        return {"models": None, "curve": None, "prior": prior}
    mixed = known.withColumn("h", F.xxhash64("doc_id"))
    some = None
    for label in (0, 1):  # at most per_class rows each
        own = mixed.where(F.col("toxic") == label).orderBy("h", "doc_id").limit(per_class)
        some = own if some is None else some.unionByName(own)
    some = some.select(F.col("doc_id").alias("id"), "toxic", F.pmod("h", F.lit(4)).cast("int").alias("part"))
    read = pick(docs, "doc_id", "text").where("doc_id is not null")
    sample = read.join(F.broadcast(some), F.col("doc_id") == F.col("id")).select(
        F.col("text").cast("string").alias("text"), "toxic", "part")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = []
        for whole in batches:
            for batch in slices(whole, "text"):
                label = batch.column("toxic").to_numpy()
                part = batch.column("part").to_numpy()
                for t in (0, 1):
                    rows = np.flatnonzero((label == t) & (part != 0))
                    words, at, _ = unique_words(texts_of(batch.column("text").take(pa.array(rows))))
                    if words:
                        g, n = grams_of(words, order)
                        often = np.repeat(np.bincount(at, minlength=len(words)), n)
                        unique, c = _sums(g, often)
                        held.append((unique, c if t else c * 0, c * 0 if t else c))
        if held:
            unique, a, b = _sums(*[np.concatenate(x) for x in zip(*held)])
            yield pa.RecordBatch.from_arrays([pa.array(unique.view(np.int64)), pa.array(a.astype(np.int64)),
                                              pa.array(b.astype(np.int64))], names=["gram", "toxic", "ordinary"])

    counted = sample.mapInArrow(count, fields(gram=LONG, toxic=LONG, ordinary=LONG)).groupBy("gram").agg(
        F.sum("toxic").alias("toxic"), F.sum("ordinary").alias("ordinary")).toArrow()
    model = kneser_ney(counted.column("gram").to_numpy().view(np.uint64), counted.column("toxic").to_numpy(),
                       counted.column("ordinary").to_numpy(), order)
    sent = spark.sparkContext.broadcast(model)

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole, "text"):
                x = features(texts_of(batch.column("text")), sent.value)
                yield pa.RecordBatch.from_arrays([*[pa.array(c) for c in x.T], batch.column("toxic")],
                                                 names=["a", "b", "c", "toxic"])

    # the models have not seen part 0; at most 2 * per_class rows of four numbers
    rows = sample.where("part = 0").mapInArrow(measure, fields(a=DOUBLE, b=DOUBLE, c=DOUBLE, toxic=INT)).toArrow()
    x = np.column_stack([rows.column(c).to_numpy() for c in "abc"])
    y = rows.column("toxic").to_numpy().astype(float)
    if not len(y) or y.min() == y.max():
        return {"models": None, "curve": None, "prior": prior}
    # undo the equal sampling of the classes
    weight = np.where(y > 0, prior / max(y.mean(), 1e-9), (1 - prior) / max(1 - y.mean(), 1e-9))
    return {"models": model, "curve": logistic(x, y, weight), "prior": prior}


def score(docs: DataFrame, model: dict) -> DataFrame:
    """``docs`` with ``toxicity`` between 0 and 1; a column of that name is replaced."""
    sent = docs.sparkSession.sparkContext.broadcast(model)
    source = carry(docs, "text").withColumn("text", F.col("text").cast("string"))
    schema = T.StructType([source.schema["row"], T.StructField("toxicity", DOUBLE)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = sent.value
        for whole in batches:
            for batch in slices(whole, "text"):
                if m["models"] is None:
                    p = np.full(batch.num_rows, m["prior"])
                else:
                    x = features(texts_of(batch.column("text")), m["models"])
                    z = m["curve"][0] + x @ m["curve"][1:]
                    p = 1 / (1 + np.exp(-np.clip(z, -30, 30)))
                yield pa.RecordBatch.from_arrays([batch.column("row"), pa.array(p)], names=["row", "toxicity"])

    return restore(source.mapInArrow(run, schema), docs, "toxicity")


def digest(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The operator's rows as the registered query returns them."""
    own = pick(docs, "doc_id", "text")
    found = score(own, train(own, labels))
    crc = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary"))
    return found.select("doc_id", (F.pmod(crc, F.lit(FOLDS)) == HELD_OUT).alias("held_out"),
                        F.col("toxicity").alias("score"),
                        (F.col("toxicity") >= THRESHOLD).cast("int").alias("predicted"))
