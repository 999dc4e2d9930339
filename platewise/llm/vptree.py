"""Approximate nearest neighbours by vantage-point trees per shard (3).

Vectors are dealt to shards of ``SHARD_ROWS`` rows on average by a hash of a row number, so a very common vector is
spread as well. Each shard builds one vantage-point tree. Queries go in blocks to every shard; a branch is skipped
if the triangle inequality, tightened by ``factor``, keeps it farther than the worst neighbour so far. Factor one
skips only what cannot hold a nearer or equally near vector, so the search is exact; larger factors skip more.
Each shard answers with its nearest rows, and the best of all shards are kept.

Distances are Euclidean, in double precision on the original components; ties go to the smaller vec_id.

Results for special input: vectors that are null, empty, zero or hold null or non-finite components, and rows with a
null vec_id, take no part; only vectors of equal length are compared; a query's own row is no candidate, but a
repeated row with its id is; a query with fewer candidates gets them all; an empty table gives no rows.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from platewise.llm.common import BINARY, DOUBLE, INT, LONG, fields, materialise, pick

NEIGHBOURS = 10
FACTOR = 5.0
SHARD_ROWS = 8192
LEAF = 64
QUERIES_PER_BLOCK = 128
BLOCKS_PER_TASK = 32
QUERY_EVERY = 100


def build(ids: np.ndarray, rows: np.ndarray, vectors: np.ndarray, leaf: int = LEAF, seed: int = 7) -> dict:
    """A tree over row numbers and vectors: nodes as (vantage row, radius, inside, outside) or (leaf rows,)."""
    random, nodes = np.random.default_rng(seed), []

    def grow(own: np.ndarray) -> int:
        k = len(nodes)
        nodes.append(None)
        if len(own) > leaf:
            at = random.integers(len(own))
            vantage, rest = own[at], np.delete(own, at)
            d = np.sqrt(((vectors[rest] - vectors[vantage]) ** 2).sum(axis=1))
            radius = float(np.median(d))
            near = d <= radius
            if near.all() and d.min() < d.max():  # many at the median: the nearer ones apart
                radius = float(d[d < d.max()].max())
                near = d <= radius
            if not near.all():
                nodes[k] = (int(vantage), radius, grow(rest[near]), grow(rest[~near]))
                return k
        nodes[k] = (own,)
        return k

    if len(ids):
        grow(np.arange(len(ids)))
    return {"ids": ids, "rows": rows, "vectors": vectors, "nodes": nodes}


def search(tree: dict, query: np.ndarray, own_row: int, k: int = NEIGHBOURS, factor: float = FACTOR) -> tuple[np.ndarray, np.ndarray, int]:
    """Indexes and distances of the k nearest in the tree by (distance, id), and how many distances it took."""
    ids, rows, vectors, nodes = tree["ids"], tree["rows"], tree["vectors"], tree["nodes"]
    best, dist, worst, taken = np.zeros(0, np.int64), np.zeros(0), np.inf, 0
    todo = [(0, 0.0)] if nodes else []
    while todo:
        at, least = todo.pop()
        if least * factor > worst:
            continue
        node = nodes[at]
        own = node[0] if len(node) == 1 else np.array([node[0]])
        d = np.sqrt(((vectors[own] - query) ** 2).sum(axis=1))
        taken += len(own)
        here = d[0]
        keep = (d <= worst) & (rows[own] != own_row)
        if keep.any():
            best, dist = np.concatenate([best, own[keep]]), np.concatenate([dist, d[keep]])
            order = np.lexsort((ids[best], dist))[:k]
            best, dist = best[order], dist[order]
            if len(best) == k:
                worst = dist[-1]
        if len(node) > 1:
            _, radius, inside, outside = node
            # a hair less than the bound, so that rounding never skips an equal distance
            branches = [(outside, max(least, (radius - here) * (1 - 1e-12))), (inside, max(least, (here - radius) * (1 - 1e-12)))]
            if here > radius:  # the nearer branch comes off the stack first
                branches.reverse()
            todo += branches
    return best, dist, taken


def vectors_of(table: DataFrame) -> DataFrame:
    """vec_id and vector of the rows that take part."""
    v = F.col("vector")
    return pick(table, "vec_id", vector="embedding").select(
        F.col("vec_id").cast("long").alias("vec_id"), v.cast("array<double>").alias("vector")) \
        .where("vec_id is not null and vector is not null and size(vector) > 0") \
        .where(F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))) \
        .where(F.exists(v, lambda x: x != 0))


def nearest(table: DataFrame, k: int = NEIGHBOURS, factor: float = FACTOR, every: int = QUERY_EVERY,
            shard_rows: int = SHARD_ROWS) -> DataFrame:
    """query_id, rank, vec_id and score (distance) of the ``k`` nearest found for rows with vec_id % every = 0."""
    rows = materialise(vectors_of(table).withColumn("row", F.monotonically_increasing_id())
                       .withColumn("dim", F.size("vector")), "vectors")
    shards = max(1, -(-rows.count() // shard_rows))
    dealt = rows.withColumn("shard", F.pmod(F.xxhash64("row"), F.lit(shards)).cast("int"))

    def grow(got: pa.Table) -> pa.Table:
        dim = got.column("dim")[0].as_py()
        vectors = got.column("vector").combine_chunks().flatten().to_numpy().reshape(-1, dim)
        tree = build(got.column("vec_id").to_numpy(), got.column("row").to_numpy(), vectors)
        return pa.table({"shard": pa.array([got.column("shard")[0].as_py()], pa.int32()),
                         "dim": pa.array([dim], pa.int32()), "tree": pa.array([pickle.dumps(tree)], pa.binary())})

    trees = dealt.groupBy("shard", "dim").applyInArrow(grow, fields(shard=INT, dim=INT, tree=BINARY))
    queries = rows.where(F.pmod("vec_id", F.lit(every)) == 0)
    blocks = max(1, -(-queries.count() // QUERIES_PER_BLOCK))
    parts = max(1, -(-blocks // BLOCKS_PER_TASK))
    numbered = queries.withColumn("block", F.pmod(F.xxhash64("row", F.lit(1)), F.lit(blocks)).cast("int"))

    def block(got: pa.Table) -> pa.Table:
        dim = got.column("dim")[0].as_py()
        data = pickle.dumps((got.column("vec_id").to_numpy(), got.column("row").to_numpy(),
                             got.column("vector").combine_chunks().flatten().to_numpy().reshape(-1, dim)))
        return pa.table({"block": pa.array([got.column("block")[0].as_py()], pa.int32()),
                         "dim": pa.array([dim], pa.int32()), "queries": pa.array([data], pa.binary())})

    # a block of queries meets each shard once; a shard's blocks are dealt over ``parts`` tasks
    asked = numbered.groupBy("block", "dim").applyInArrow(block, fields(block=INT, dim=INT, queries=BINARY)) \
        .withColumn("part", F.col("block") % parts).withColumn("shard", F.explode(F.sequence(F.lit(0), F.lit(shards - 1))))
    held = trees.withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(parts - 1))))

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, tree = None, None
        for batch in batches:
            for i in range(batch.num_rows):
                raw = batch.column("tree")[i].as_buffer()
                if last is None or not raw.equals(last):
                    last, tree = raw, pickle.loads(raw)
                ids, rows_, vectors = pickle.loads(batch.column("queries")[i].as_py())
                out = []
                for q, r, v in zip(ids.tolist(), rows_.tolist(), vectors):
                    best, dist, _ = search(tree, v, r, k, factor)
                    out += [(q, r, x, y) for x, y in zip(tree["ids"][best].tolist(), dist.tolist())]
                columns = list(zip(*out)) or [[]] * 4
                yield pa.RecordBatch.from_arrays([*[pa.array(c, pa.int64()) for c in columns[:3]],
                                                  pa.array(columns[3], pa.float64())], names=found.names)

    found = fields(query_id=LONG, query_row=LONG, vec_id=LONG, score=DOUBLE)
    answers = held.join(asked, ["shard", "dim", "part"]).select("tree", "queries").mapInArrow(find, found)
    order = Window.partitionBy("query_row").orderBy("score", "vec_id")
    return answers.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k) \
        .select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
