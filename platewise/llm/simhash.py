"""SimHash near-duplicates by the generalised pigeonhole (7).

Fingerprint: A-Z lower-cased words ``[^\\x20\\x09-\\x0D]+``, 3-word shingles with repeats, XXH64 (seed 42) each; a
bit is set if it is set in over half the hashes. Two fingerprints within ``max_bits`` bits are linked.

Search over the distinct fingerprints: correlated bits are grouped into m partitions. By the generalised
pigeonhole, two fingerprints within tau bits differ in at most t(i) bits in some partition i whenever the sum of
the t(i) is tau - m + 1 (t = -1 leaves a partition out). Each fingerprint gets its own thresholds from a dynamic
programme over the estimated number of candidates in each partition, then probes the partition's index with all
keys within t(i) bits. Candidates are verified on all 64 bits, so the links are exact. m itself is the number of
partitions with the least estimated work, so keys get longer as the table grows. Correlations, counts and work are
added up over all distinct fingerprints in the tasks.

Results for special input: null and empty texts have fingerprint zero and link like any other; fewer words than a
shingle are one shingle; repeated rows each get a row; a null doc_id takes part, and a component's id is its
smallest non-null doc_id; an empty table gives no rows; very long texts are hashed whole.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F, types as T

from platewise.llm.common import DOUBLE, INT, LONG, carry, fields, materialise, pick, restore, slices, texts_of
from platewise.llm.components import components

SHINGLE = 3
MAX_BITS = 3
SEED = 42
#: Estimated work of one probe and of one candidate, relative to each other.
PROBE_COST, CANDIDATE_COST = 1.0, 0.5
_BLOCK = 8


def fingerprints_of(texts: list[bytes], shingle: int = SHINGLE, seed: int = SEED) -> np.ndarray:
    """uint64 fingerprints of UTF-8 texts."""
    hashes: list[int] = []
    counts = np.zeros(len(texts), np.int64)
    digest = xxhash.xxh64_intdigest
    for i, text in enumerate(texts):
        words = text.lower().split()
        if not words:
            continue
        line = b" ".join(words)
        ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1)
        starts = ends - np.fromiter(map(len, words), np.int64, len(words)) - 1
        last = ends[shingle - 1:] - 1 if len(words) >= shingle else ends[-1:] - 1
        hashes += [digest(line[a:b], seed) for a, b in zip(starts.tolist(), last.tolist())]
        counts[i] = len(last)
    out = np.zeros(len(texts), np.uint64)
    has = np.flatnonzero(counts)
    if len(has):
        bits = np.unpackbits(np.array(hashes, dtype=np.uint64).astype(">u8").view(np.uint8).reshape(-1, 8), axis=1)
        first = np.cumsum(counts[has]) - counts[has]
        ones = np.add.reduceat(bits, first, axis=0, dtype=np.int32)
        out[has] = np.packbits(ones * 2 > counts[has][:, None], axis=1).view(">u8").reshape(-1)
    return out


def with_fingerprint(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """``docs`` with ``fp``, the fingerprint as a signed long; a column of that name is replaced."""
    source = carry(docs, "text").withColumn("text", F.col("text").cast("string"))
    schema = T.StructType([source.schema["row"], T.StructField("fp", LONG)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole, "text"):
                fp = fingerprints_of(texts_of(batch.column("text")), shingle).view(np.int64)
                yield pa.RecordBatch.from_arrays([batch.column("row"), pa.array(fp)], names=["row", "fp"])

    return restore(source.mapInArrow(run, schema), docs, "fp")


def unpacked(fp: np.ndarray) -> np.ndarray:
    """The 64 bits of each fingerprint, highest first."""
    return np.unpackbits(fp.astype(">u8").view(np.uint8).reshape(-1, 8), axis=1).astype(np.float64)


def group_bits(bits: np.ndarray, parts: int) -> list[list[int]]:
    """``group_tied`` by the correlations of the columns of ``bits``."""
    return group_tied(bits.T @ bits, len(bits), parts)


def group_tied(both: np.ndarray, n: int, parts: int) -> list[list[int]]:
    """Bit positions (0: highest) in ``parts`` groups of nearly equal size, correlated ones together; of ``n``
    fingerprints ``both[i, j]`` have bits i and j."""
    width = len(both)
    share = np.diag(both) / max(1, n)
    apart = both / max(1, n) - np.outer(share, share)
    scale = np.sqrt(np.maximum(0, share - share * share))
    scale[scale == 0] = 1
    tied = np.abs(apart / np.outer(scale, scale))
    np.fill_diagonal(tied, 0)
    left, groups = set(range(width)), []
    for k in range(parts):
        size = len(left) // (parts - k)
        rest = sorted(left)
        own = [max(rest, key=lambda b: (tied[b, rest].max(), -b))]
        while len(own) < size:
            rest = [b for b in rest if b not in own]
            own.append(max(rest, key=lambda b: (tied[b, own].mean(), -b)))
        groups.append(sorted(own))
        left -= set(own)
    return groups


def project(fp: np.ndarray, group: list[int]) -> np.ndarray:
    """The group's bits of each fingerprint, as a number whose bit j is the group's j-th bit."""
    out = np.zeros(len(fp), np.uint64)
    for j, b in enumerate(group):
        out |= ((fp >> np.uint64(63 - b)) & np.uint64(1)) << np.uint64(j)
    return out


def _blocks(group: list[int]) -> list[tuple[int, int]]:
    return [(a, min(_BLOCK, len(group) - a)) for a in range(0, len(group), _BLOCK)]


def block_counts(fp: np.ndarray, group: list[int]) -> np.ndarray:
    """How often each value of each eight-bit block of the group occurs: (blocks, 256)."""
    key = project(fp, group)
    return np.array([np.bincount(((key >> np.uint64(a)) & np.uint64((1 << n) - 1)).astype(np.int64), minlength=256)
                     for a, n in _blocks(group)])


_APART = np.bitwise_count(np.arange(256)[:, None] ^ np.arange(256)[None, :])


def estimate(fp: np.ndarray, group: list[int], counts: np.ndarray, tau: int) -> np.ndarray:
    """Estimated number of fingerprints within 0..tau bits in this group, per query: (queries, tau + 1).

    The blocks' exact distance distributions are convolved, as if blocks were independent."""
    total = max(1, counts[0].sum()) if len(counts) else 1
    key = project(fp, group)
    chance = np.zeros((len(fp), tau + 1))
    chance[:, 0] = 1
    for (a, n), c in zip(_blocks(group), counts):
        near = np.stack([((_APART == d) * c[None, :]).sum(axis=1) for d in range(tau + 1)], axis=1) / total
        own = near[((key >> np.uint64(a)) & np.uint64((1 << n) - 1)).astype(np.int64)]
        chance = np.stack([sum(chance[:, j] * own[:, d - j] for j in range(d + 1)) for d in range(tau + 1)], axis=1)
    return np.cumsum(chance, axis=1) * total


def _ball(width: int, t: int) -> np.ndarray:
    return np.array([sum(1 << b for b in on) for d in range(t + 1) for on in combinations(range(width), d)],
                    dtype=np.uint64)


def allocate(fp: np.ndarray, groups: list[list[int]], counts: list[np.ndarray], tau: int) -> tuple[np.ndarray, np.ndarray]:
    """Thresholds of each query and partition, -1 to tau, with sum tau - m + 1 and the least estimated work; and
    that work. Dynamic programme over the partitions, for all queries at once."""
    m, n = len(groups), len(fp)
    goal = tau + 1  # the sum of t + 1
    best = np.full((n, goal + 1), np.inf)
    best[:, 0] = 0
    choice = np.zeros((m, n, goal + 1), np.int8)
    for i, (g, c) in enumerate(zip(groups, counts)):
        near = estimate(fp, g, c, tau)
        probes = np.cumsum([1.0, *[_choose(len(g), d) for d in range(1, tau + 1)]])
        cost = np.concatenate([np.zeros((n, 1)), PROBE_COST * probes + CANDIDATE_COST * near], axis=1)
        new = np.full_like(best, np.inf)
        for s in range(goal + 1):
            for u in range(s + 1):
                x = best[:, s - u] + cost[:, u]
                better = x < new[:, s]
                new[better, s] = x[better]
                choice[i, better, s] = u
        best = new
    t = np.zeros((n, m), np.int8)
    s = np.full(n, goal)
    for i in range(m - 1, -1, -1):
        u = choice[i, np.arange(n), s]
        t[:, i] = u - 1
        s = s - u
    return t, best[:, goal]


def _choose(n: int, k: int) -> int:
    out = 1
    for j in range(k):
        out = out * (n - j) // (j + 1)
    return out


def plan(fps: DataFrame, tau: int, sample: int | None = None) -> tuple[list[list[int]], list[np.ndarray]]:
    """Bit groups and their block counts over all fingerprints, for the cheapest number of partitions: that of the least
    work over all of them, or over ``sample`` of them (the smallest by hash)."""
    def together(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, both = 0, np.zeros((64, 64))
        for batch in batches:
            for a in range(0, batch.num_rows, 1 << 16):
                bits = unpacked(batch.slice(a, 1 << 16).column("fp").to_numpy().view(np.uint64))
                n, both = n + len(bits), both + bits.T @ bits
        i, j = np.divmod(np.arange(64 * 64), 64)
        yield pa.RecordBatch.from_arrays([pa.array(x.astype(np.int32)) for x in (i, j)] +
                                         [pa.array(both.reshape(-1).astype(np.int64)), pa.array(np.full(64 * 64, n))],
                                         names=["i", "j", "both", "n"])

    # 64 x 64 rows, whatever the input
    rows = fps.mapInArrow(together, fields(i=INT, j=INT, both=LONG, n=LONG)).groupBy("i", "j").agg(
        F.sum("both").alias("both"), F.sum("n").alias("n")).collect()
    both = np.zeros((64, 64))
    for r in rows:
        both[r.i, r.j] = r.both
    ways = [group_tied(both, rows[0].n if rows else 0, m) for m in (range(2, tau + 2) if tau else [1])]

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = None
        for batch in batches:
            fp = batch.column("fp").to_numpy().view(np.uint64)
            new = [[block_counts(fp, g) for g in way] for way in ways]
            sums = new if sums is None else [[a + b for a, b in zip(x, y)] for x, y in zip(sums, new)]
        flat = [(w, g, b, v, int(n)) for w, way in enumerate(sums or []) for g, c in enumerate(way)
                for b, v in zip(*map(np.ndarray.tolist, np.nonzero(c))) for n in [c[b, v]]]
        columns = list(zip(*flat)) or [[]] * 5
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int32()) for c in columns[:4]] + [pa.array(columns[4], pa.int64())],
                                         names=["way", "g", "block", "value", "n"])

    # at most 3 ways * 64 bits / 8 * 256 rows, whatever the input
    rows = fps.mapInArrow(count, fields(way=INT, g=INT, block=INT, value=INT, n=LONG)) \
        .groupBy("way", "g", "block", "value").agg(F.sum("n").alias("n")).collect()
    counts = [[np.zeros((len(_blocks(g)), 256)) for g in way] for way in ways]
    for r in rows:
        counts[r.way][r.g][r.block, r.value] = r.n

    def effort(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        work = np.zeros(len(ways))
        for batch in batches:
            for a in range(0, batch.num_rows, 4096):
                fp = batch.slice(a, 4096).column("fp").to_numpy().view(np.uint64)
                work += [allocate(fp, way, c, tau)[1].sum() for way, c in zip(ways, counts)]
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(ways), dtype=np.int32)), pa.array(work)], names=["way", "work"])

    some = fps if sample is None else fps.orderBy(F.xxhash64("fp")).limit(sample)
    work = some.mapInArrow(effort, fields(way=INT, work=DOUBLE)).groupBy("way").agg(F.sum("work").alias("work")).collect()
    k = min(work, key=lambda r: (r.work, r.way)).way if work else 0
    return ways[k], counts[k]


def links(fps: DataFrame, tau: int = MAX_BITS, sample: int | None = None) -> DataFrame:
    """(a, b): all pairs of distinct fingerprints (column fp) within ``tau`` bits, a < b."""
    groups, counts = plan(fps, tau, sample)
    schema = fields(part=INT, key=LONG, fp=LONG)
    balls = {(i, t): _ball(len(g), t) for i, g in enumerate(groups) for t in range(tau + 1)
             if _choose(len(g), t) <= 1 << 20}

    def rows(part: np.ndarray, key: np.ndarray, fp: np.ndarray) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(part.astype(np.int32)), pa.array(key.view(np.int64)),
                                           pa.array(fp.view(np.int64))], names=schema.names)

    def index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fp = batch.column("fp").to_numpy().view(np.uint64)
            for i, g in enumerate(groups):
                yield rows(np.full(len(fp), i), project(fp, g), fp)

    def probe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a in range(0, batch.num_rows, 4096):
                fp = batch.slice(a, 4096).column("fp").to_numpy().view(np.uint64)
                t, _ = allocate(fp, groups, counts, tau)
                for i, g in enumerate(groups):
                    for u in range(tau + 1):
                        own = fp[t[:, i] == u]
                        ball = balls[i, u]
                        for b in range(0, len(ball) if len(own) else 0, 1024):
                            key = (project(own, g)[:, None] ^ ball[None, b:b + 1024]).reshape(-1)
                            yield rows(np.full(len(key), i), key, np.repeat(own, len(ball[b:b + 1024])))

    left = fps.mapInArrow(probe, schema).withColumnRenamed("fp", "q")
    right = fps.mapInArrow(index, schema)
    near = F.bit_count(F.col("q").bitwiseXOR(F.col("fp"))) <= tau
    return left.join(right, (left.part == right.part) & (left.key == right.key) & near & (F.col("q") != F.col("fp"))) \
        .select(F.least("q", "fp").alias("a"), F.greatest("q", "fp").alias("b")).distinct()


def near_duplicates(hashed: DataFrame, tau: int = MAX_BITS, sample: int | None = None) -> DataFrame:
    """(fp, label, component_id) of every distinct fingerprint in ``hashed`` (doc_id, fp): the smallest fingerprint and
    the smallest doc_id reachable."""
    least = materialise(hashed.groupBy("fp").agg(F.min("doc_id").alias("least")), "fingerprints")
    if least.isEmpty():
        return least.select("fp", F.col("fp").alias("label"), F.col("least").alias("component_id"))
    labels = components(links(least.select("fp"), tau, sample))
    named = least.join(labels.withColumnRenamed("node", "fp"), "fp", "left") \
        .select("fp", "least", F.coalesce("label", "fp").alias("label"))
    low = named.groupBy("label").agg(F.min("least").alias("component_id"))
    return materialise(named.join(low, "label").select("fp", "label", "component_id"), "components")


def digest(docs: DataFrame, shingle: int = SHINGLE, tau: int = MAX_BITS) -> DataFrame:
    """The operator's rows as the registered query returns them."""
    hashed = materialise(with_fingerprint(pick(docs, "doc_id", "text"), shingle).select("doc_id", "fp"), "hashed")
    found = near_duplicates(hashed, tau)
    return hashed.join(found, "fp").select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
                                           "component_id")


def deduplicate(docs: DataFrame, shingle: int = SHINGLE, tau: int = MAX_BITS) -> DataFrame:
    """``docs`` with one row of each component: that of its smallest doc_id (null last, then the first of repeated
    rows as they were read)."""
    numbered = carry(docs, "doc_id", "text").withColumn("uid", F.monotonically_increasing_id())
    whole = materialise(with_fingerprint(numbered, shingle).drop("text"), "numbered")
    found = near_duplicates(whole.select("doc_id", "fp"), tau)
    # the component's smallest doc_id names it only where it has one: its fingerprints' least label does always
    first = whole.select("fp", "uid", "doc_id").join(found, "fp").groupBy("label").agg(
        F.min(F.struct(F.col("doc_id").isNull().alias("n"), "doc_id", "uid")).alias("m")).select(F.col("m.uid").alias("uid"))
    return restore(whole.join(first, "uid", "left_semi"), docs)
