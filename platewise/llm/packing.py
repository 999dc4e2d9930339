"""Bound-certified best-fit packing (4).

Documents become token ids with an end id; only documents longer than ``capacity`` are cut. Pieces are dealt to
partitions by a hash and packed there by best-fit decreasing. Each partition's number of bins is certified by
lower bounds from dual feasible functions (volume, the rounding family u(k), the threshold family f(eps)).
Partitions whose bins exceed their bound keep their full bins, exchange the documents of the others and run
best-fit decreasing again over fewer, newly mixed partitions, as long as that saves bins. Certified partitions join
the exchange with their emptiest bin, what rounding up to whole bins has left over.

Results for special input: a null or empty text is the end id alone; repeated documents are packed each; an empty
table gives no rows; texts of any length are cut into as many pieces as needed. A null doc_id stays null.
Only lengths and keys move between tasks: a partition holds ``PER_PARTITION`` pieces on average, whatever the input.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left, insort
from collections.abc import Iterator
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F, types as T

from platewise.llm.common import BINARY, BOOL, INT, LONG, fields, materialise, pick, slices
from platewise.llm.tokens import END_ID, VOCABULARY, FastTokenizer

CAPACITY = 4096
PER_PARTITION = 100_000
_PLACED = fields(part=INT, bin=INT, offset=LONG, bins=LONG, bound=LONG, open=BOOL)


def pieces(docs: DataFrame, capacity: int = CAPACITY, vocabulary: str = VOCABULARY, end_id: int = END_ID,
           keep_ids: bool = False) -> DataFrame:
    """One row per piece: pid (unique within the result once written), doc_id, piece, start, length, ids_crc32, and
    the little-endian uint32 ids if asked for."""
    source = pick(docs, "doc_id", "text").withColumn("text", F.col("text").cast("string"))
    schema = T.StructType([T.StructField("pid", LONG), source.schema["doc_id"],
                           *fields(piece=INT, start=LONG, length=LONG, ids_crc32=LONG).fields,
                           *(fields(ids=BINARY).fields if keep_ids else [])])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer, made, task = None, 0, TaskContext.get().partitionId()
        for whole in batches:
            tokenizer = tokenizer or FastTokenizer(vocabulary)
            for batch in slices(whole, "text", 8 << 20):
                ids, at = tokenizer.flat(batch.column("text"))
                row, piece, start, length, crc, data = [], [], [], [], [], []
                for i, (a, b) in enumerate(zip(at[:-1].tolist(), at[1:].tolist())):
                    own = np.append(ids[a:b], np.uint32(end_id))
                    for k, s in enumerate(range(0, len(own), capacity)):
                        raw = own[s:s + capacity].tobytes()
                        row.append(i), piece.append(k), start.append(s), length.append(len(raw) // 4)
                        crc.append(zlib.crc32(raw)), data.append(raw if keep_ids else None)
                columns = [pa.array(np.arange(made, made + len(row)) + (task << 40), pa.int64()),
                           batch.column("doc_id").take(pa.array(row, pa.int64())), pa.array(piece, pa.int32()),
                           pa.array(start, pa.int64()), pa.array(length, pa.int64()), pa.array(crc, pa.int64())]
                made += len(row)
                yield pa.RecordBatch.from_arrays(columns + [pa.array(data, pa.binary())] * keep_ids,
                                                 names=schema.names)

    return source.mapInArrow(cut, schema)


def lower_bound(sizes: np.ndarray, capacity: int) -> int:
    """Bins that any packing needs: the largest bound of three families of dual feasible functions."""
    if not len(sizes):
        return 0
    count = np.bincount(sizes, minlength=capacity + 1).astype(np.int64)
    x = np.arange(capacity + 1, dtype=np.int64)
    best = -(-int((count * x).sum()) // capacity)
    for k in range(2, 21):  # u(k): sizes rounded to multiples of 1/k, exact where (k + 1) x is whole
        up = (k + 1) * x
        exact = up % capacity == 0
        # in units of 1 / (k * capacity): x * k, or floor((k + 1) x / capacity) * capacity
        value = np.where(exact, x * k, up // capacity * capacity)
        best = max(best, -(-int((count * value).sum()) // (k * capacity)))
    n, total = np.cumsum(count), np.cumsum(count * x)
    half = capacity // 2
    eps = np.arange(0, half + 1)  # f(eps): sizes over capacity - eps count whole, those under eps nothing
    big = n[capacity] - n[capacity - eps]
    middle = n[capacity - eps] - n[half]
    small = total[half] - np.where(eps > 0, total[np.maximum(eps - 1, 0)], 0)
    room = middle * capacity - (total[capacity - eps] - total[half])
    extra = np.maximum(0, -(-(small - room) // capacity))
    return max(best, int((big + middle + extra).max()))


def best_fit_decreasing(sizes: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bin and offset of each item, and the free room of each bin."""
    order = np.argsort(-sizes, kind="stable")
    where, offset = np.zeros(len(sizes), np.int64), np.zeros(len(sizes), np.int64)
    rooms: list[int] = []  # the distinct free rooms, ascending
    with_room: dict[int, list[int]] = {}
    free: list[int] = []
    for i, size in zip(order.tolist(), sizes[order].tolist()):
        k = bisect_left(rooms, size)
        if k == len(rooms):
            b = len(free)
            free.append(capacity)
        else:
            room = rooms[k]
            b = with_room[room].pop()
            if not with_room[room]:
                del with_room[room], rooms[k]
        where[i], offset[i] = b, capacity - free[b]
        free[b] -= size
        if free[b]:
            if free[b] not in with_room:
                with_room[free[b]] = []
                insort(rooms, free[b])
            with_room[free[b]].append(b)
    return where, offset, np.array(free, dtype=np.int64)


def _pack_partitions(pool: DataFrame, parts: int, seed: int, capacity: int) -> DataFrame:
    """Best-fit decreasing in each of ``parts`` hashed partitions, with its certificate."""
    kept = [c for c in pool.columns if c not in _PLACED.names]
    schema = T.StructType([*pool.select(*kept).schema.fields, *_PLACED.fields])

    def run(got: pa.Table) -> pa.Table:
        sizes = got.column("length").to_numpy()
        where, offset, free = best_fit_decreasing(sizes, capacity)
        n, bound = got.num_rows, lower_bound(sizes, capacity)
        open_ = free > 0 if len(free) > bound else (np.arange(len(free)) == free.argmax()) & (free > 0)
        out = got.select(kept)
        for name, values in (("part", np.full(n, got.column("part")[0].as_py(), np.int32)),
                             ("bin", where.astype(np.int32)), ("offset", offset),
                             ("bins", np.full(n, len(free), np.int64)),
                             ("bound", np.full(n, bound, np.int64)), ("open", open_[where])):
            out = out.append_column(name, pa.array(values))
        return out

    dealt = pool.select(*kept).withColumn("part", F.pmod(F.xxhash64("pid", F.lit(seed)), F.lit(parts)).cast("int"))
    return dealt.groupBy("part").applyInArrow(run, schema)


def _bins(df: DataFrame) -> DataFrame:
    return df.select("part", "bin").distinct()


def pack(cut: DataFrame, capacity: int = CAPACITY, per_partition: int = PER_PARTITION,
         rounds: int | None = None) -> DataFrame:
    """Places the rows of ``pieces``; adds sequence_id and offset, and round, bins and bound of the partition that
    packed them. ``cut`` must be a written table (its pids are read several times). Exchanges go on while they save
    bins and there are several partitions, whose number falls each time; ``rounds`` sets a limit beside that."""
    done = cut.where(F.col("length") == capacity).select(
        "*", (-F.col("pid") - 1).alias("sequence_id"), F.lit(0).cast("long").alias("offset"),
        F.lit(-1).alias("round"), F.lit(1).cast("long").alias("bins"), F.lit(1).cast("long").alias("bound"))
    pool = cut.where(F.col("length") < capacity)
    left = pool.count()
    parts = max(1, -(-left // per_partition))
    before, first = None, 0
    for k in count() if rounds is None else range(rounds):
        if not left:
            break
        new = materialise(_pack_partitions(pool, parts, k, capacity), f"packed{k}")
        after = _bins(new).count()
        if before is not None and after >= before[1]:
            new, last = before[0], True  # the exchange saved nothing: the earlier places stand
        else:
            last = parts == 1 or k + 1 == rounds
        pool = new.where("open")
        left = 0 if last else pool.count()
        stay = new if not left else new.where("not open")
        done = done.unionByName(stay.select(*cut.columns, (
            (F.lit(first).cast("long") + F.col("part")) * (1 << 32) + F.col("bin")
        ).alias("sequence_id"), "offset", F.lit(k).alias("round"), "bins", "bound"))
        if left:
            before = (pool, _bins(pool).count())
            first += parts
            parts = max(1, min(parts - 1, -(-left // per_partition)))
    return done


def digest(placed: DataFrame) -> DataFrame:
    """The operator's rows as the registered query returns them."""
    return placed.select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset",
                         "round", "bins", "bound")


def pack_documents(docs: DataFrame, capacity: int = CAPACITY, keep_ids: bool = False, **how) -> DataFrame:
    """Documents to placed pieces, with their ids if asked for."""
    cut = materialise(pieces(docs, capacity, keep_ids=keep_ids), "pieces")
    placed = pack(cut.drop("ids"), capacity, **how)
    return placed.join(cut.select("pid", "ids"), "pid") if keep_ids else placed
