"""Training-order materialisation (2).

Documents become token ids with an end id and are cut into sequences of ``SEQUENCE`` ids, the last one padded. With
n sequences in all, a keyed Feistel permutation of the smallest even number of bits that covers n, walked along its
cycle until it falls below n, gives the sequence of index i its global slot. Slots are cut into ranges of equal
size; each range is one shard file of fixed-stride records in slot order. So the record of a slot is found by
arithmetic, a reader can stop after any slot and go on from the next, and the order can be rebuilt from the key.

Record: doc_id (little-endian int64), piece (uint32; the highest bit marks a null doc_id), number of ids (uint32),
then ``SEQUENCE`` ids (uint16 or uint32 by the vocabulary's size), padded with ``PAD``. A shard file ends with one
line feed, which Spark's text writer puts there.

The tokenised blocks are written once; the index of a sequence is its place in them. A task holds one block or one
shard (``SHARD_BYTES``); only the number of sequences of each input split goes to the driver.

Results for special input: a null or empty text is one sequence with the end id; repeated rows get sequences each;
an empty table writes no shard and gives no rows; texts of any length are cut whole.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, functions as F

from tokenizers import Tokenizer

from platewise.llm.common import (
    BINARY, INT, LONG, fields, give_back, materialise, mix, pack, pick, run_dir, slices, unpack,
)
from platewise.llm.tokens import END_ID, VOCABULARY, FastTokenizer

SEQUENCE = 512
SHARD_BYTES = 8 << 20
BLOCK_BYTES = 4 << 20
#: Bytes of ids that a task groups by shard at once.
GROUPED_BYTES = 32 << 20
#: Compression of ids on their way to the shards.
LEVEL = 5
KEY = 20240229
PAD = 0
ROUNDS = 6
_HEAD = 16
_NULL = 1 << 31


def permute(index: np.ndarray, n: int, key: int = KEY, rounds: int = ROUNDS, inverse: bool = False) -> np.ndarray:
    """Slots of indexes under the keyed permutation of range(n), or indexes of slots."""
    half = max(1, (max(1, n - 1).bit_length() + 1) // 2)
    mask, shift = np.uint64((1 << half) - 1), np.uint64(half)
    with np.errstate(over="ignore"):
        keys = mix(np.arange(1, rounds + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(key & (2**64 - 1)))

        def once(x: np.ndarray) -> np.ndarray:
            left, right = x >> shift, x & mask
            for k in (reversed(keys) if inverse else keys):
                if inverse:
                    left, right = right ^ (mix(left + k) & mask), left
                else:
                    left, right = right, left ^ (mix(right + k) & mask)
            return (left << shift) | right

        out = once(np.asarray(index, dtype=np.uint64))
        while (out >= n).any():  # walk the cycle until back in range
            far = np.flatnonzero(out >= n)
            out[far] = once(out[far])
    return out.astype(np.int64)


def _squeeze(ids: np.ndarray, kind: np.dtype) -> bytes:
    """Token ids compressed as ranks by frequency (small numbers repeat more), with the ranking."""
    often = np.bincount(ids)
    order = np.argsort(-often, kind="stable")[:np.count_nonzero(often)]
    rank = np.zeros(len(often), kind)
    rank[order] = np.arange(len(order))
    head = pack(order.astype(np.uint32))
    return len(head).to_bytes(8, "little") + head + zstandard.ZstdCompressor(level=LEVEL).compress(rank[ids].tobytes())


def _unsqueeze(data: bytes | pa.Buffer, kind: np.dtype) -> np.ndarray:
    data = memoryview(data)
    size = int.from_bytes(data[:8], "little")
    order = unpack(data[8:8 + size], np.uint32)
    return order[np.frombuffer(zstandard.ZstdDecompressor().decompress(data[8 + size:]), kind)].astype(kind)


def _width(vocabulary: str) -> int:
    return 2 if Tokenizer.from_file(public_tokenizers.path(vocabulary)).get_vocab_size() <= 1 << 16 else 4


def blocks_of(docs: DataFrame, sequence: int = SEQUENCE, vocabulary: str = VOCABULARY, end_id: int = END_ID,
              bytes_per_id: int = 2) -> DataFrame:
    """Blocks of tokenised sequences: the input split, the number of its sequences before the block, the block's
    number of sequences, and their doc_ids, pieces, lengths and ids, compressed."""
    source = pick(docs, "doc_id", "text").withColumn("text", F.col("text").cast("string")) \
        .withColumn("doc_id", F.col("doc_id").cast("long"))
    schema = fields(split=INT, before=LONG, n=LONG, heads=BINARY, ids=BINARY)
    kind = np.dtype(f"<u{bytes_per_id}")

    def tokenise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer, before, split = None, 0, TaskContext.get().partitionId()
        for whole in batches:
            tokenizer = tokenizer or FastTokenizer(vocabulary)
            for batch in slices(whole, "text", BLOCK_BYTES):
                flat, at = tokenizer.flat(batch.column("text"))
                size = np.diff(at) + 1
                ids = np.full(int(size.sum()), end_id, kind)
                ids[np.arange(len(flat)) + np.repeat(np.arange(len(size)), size - 1)] = flat
                pieces = -(-size // sequence)
                doc = np.repeat(np.arange(len(size)), pieces)
                piece = np.arange(len(doc)) - (np.cumsum(pieces) - pieces)[doc]
                length = np.minimum(sequence, size[doc] - piece * sequence)
                column = batch.column("doc_id")
                null = np.asarray(column.is_null(), dtype=bool)[doc]
                name = column.fill_null(0).to_numpy(zero_copy_only=False)[doc]
                heads = [pack(x) for x in (name, (piece | np.where(null, _NULL, 0)).astype(np.uint32), length.astype(np.uint32))]
                sizes = np.array([len(h) for h in heads], "<i8").tobytes()
                yield pa.RecordBatch.from_arrays([
                    pa.array([split], pa.int32()), pa.array([before], pa.int64()), pa.array([len(doc)], pa.int64()),
                    pa.array([sizes + b"".join(heads)], pa.binary()), pa.array([_squeeze(ids, kind)], pa.binary())], names=schema.names)
                before += len(doc)
                del flat, ids, doc, piece, length, name, null, heads
        del tokenizer
        give_back()

    return source.mapInArrow(tokenise, schema)


def _heads(data: bytes) -> list[np.ndarray]:
    at, out = 24, []
    for size, kind in zip(np.frombuffer(data, "<i8", 3).tolist(), (np.int64, np.uint32, np.uint32)):
        out.append(unpack(data[at:at + size], kind))
        at += size
    return out


def write_shards(docs: DataFrame, path: str, sequence: int = SEQUENCE, key: int = KEY, shard_bytes: int = SHARD_BYTES,
                 vocabulary: str = VOCABULARY, end_id: int = END_ID) -> dict:
    """Writes the shards under ``path`` (folders shard=k) and returns what a reader needs: the number of sequences,
    records per shard, stride, ids per sequence, bytes per id and the key."""
    size = _width(vocabulary)
    stride = _HEAD + size * sequence
    per_shard = max(1, shard_bytes // stride)
    kind = np.dtype(f"<u{size}")
    blocks = materialise(blocks_of(docs, sequence, vocabulary, end_id, size), "sequences")
    splits = sorted((r[0], r[1]) for r in blocks.groupBy("split").agg(F.sum("n")).collect())
    first, total = {}, 0
    for split, n in splits:
        first[split] = total
        total += n
    layout = {"sequences": total, "per_shard": per_shard, "stride": stride, "sequence": sequence, "bytes_per_id": size, "key": key}
    if not total:
        return layout
    shards = -(-total // per_shard)
    moved = fields(shard=INT, data=BINARY)

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, ids, n_ids = [], np.empty(0, kind), 0
        for batch in batches:
            for i in range(batch.num_rows):
                split, before, n = (batch.column(c)[i].as_py() for c in range(3))
                slot = permute(first[split] + before + np.arange(n), total, key)
                held.append((slot, *_heads(batch.column(3)[i].as_py())))
                own = _unsqueeze(batch.column(4)[i].as_buffer(), kind)
                if n_ids + len(own) > len(ids):  # one buffer for all groups of the task
                    ids = np.concatenate([ids[:n_ids], np.empty(max(len(own), GROUPED_BYTES // kind.itemsize // 4), kind)])
                ids[n_ids:n_ids + len(own)] = own
                n_ids += len(own)
                if n_ids * kind.itemsize >= GROUPED_BYTES:
                    yield from grouped(held, ids[:n_ids])
                    held, n_ids = [], 0
        if held:
            yield from grouped(held, ids[:n_ids])
        del held, ids
        give_back()

    def grouped(held: list, ids: np.ndarray) -> Iterator[pa.RecordBatch]:
        """Records grouped by shard, so that they travel and compress together."""
        slot, name, piece, length = (np.concatenate(x) for x in zip(*held))
        start = np.cumsum(length, dtype=np.int64) - length
        order = np.argsort(slot)
        shard = slot[order] // per_shard
        edge = np.flatnonzero(np.diff(shard, prepend=-1))
        for a, b in zip(edge.tolist(), [*edge[1:].tolist(), len(slot)]):
            own = order[a:b]
            where = np.repeat(start[own] - (np.cumsum(length[own], dtype=np.int64) - length[own]), length[own])
            parts = [pack(x) for x in (slot[own], name[own], piece[own], length[own])]
            parts.append(zstandard.ZstdCompressor(level=LEVEL).compress(ids[where + np.arange(len(where))].tobytes()))
            data = np.array([len(p) for p in parts], "<i8").tobytes() + b"".join(parts)
            yield pa.RecordBatch.from_arrays([pa.array([shard[a]], pa.int32()), pa.array([data], pa.binary())],
                                             names=moved.names)

    def assemble(got: pa.Table) -> pa.Table:
        k = got.column("shard")[0].as_py()
        base = k * per_shard
        count = min(per_shard, total - base)
        out = np.full((count, stride), 0, np.uint8)
        body = out.view(kind)[:, _HEAD // size:]
        body[:] = PAD
        for data in got.column("data"):
            data = data.as_py()
            at, parts = 40, []
            for n, d in zip(np.frombuffer(data, "<i8", 4).tolist(), (np.int64, np.int64, np.uint32, np.uint32)):
                parts.append(unpack(data[at:at + n], d))
                at += n
            slot, name, piece, length = parts
            ids = np.frombuffer(zstandard.ZstdDecompressor().decompress(data[at:]), kind)
            row = slot - base
            out[row, 0:8] = name.astype("<i8").view(np.uint8).reshape(-1, 8)
            out[row, 8:12] = piece.astype("<u4").view(np.uint8).reshape(-1, 4)
            out[row, 12:16] = length.astype("<u4").view(np.uint8).reshape(-1, 4)
            column = np.arange(len(ids)) - np.repeat(np.cumsum(length, dtype=np.int64) - length, length)
            body[np.repeat(row, length), column] = ids
        value = pa.Array.from_buffers(pa.binary(), 1, [None, pa.py_buffer(np.array([0, out.size], np.int32)), pa.py_buffer(out)])
        return pa.table({"shard": pa.array([k], pa.int32()), "value": value})

    files = blocks.mapInArrow(place, moved).repartition(min(shards, 1 << 20), "shard").groupBy("shard") \
        .applyInArrow(assemble, fields(shard=INT, value=BINARY))
    files.select("shard", F.col("value").cast("string").alias("value")).write.partitionBy("shard") \
        .option("compression", "none").text(path)
    return layout


def read_slots(spark: SparkSession, path: str, layout: dict, start: int = 0, stop: int | None = None,
               with_ids: bool = True) -> DataFrame:
    """slot, shard, byte_offset, doc_id, piece, n_tokens, ids_crc32 and, if asked for, the ids (little-endian
    uint32) of the slots from ``start`` to before ``stop``. Only the shards that hold them are read."""
    n, per_shard, stride = layout["sequences"], layout["per_shard"], layout["stride"]
    stop = n if stop is None else min(stop, n)
    kind = np.dtype(f"<u{layout['bytes_per_id']}")
    schema = fields(slot=LONG, shard=INT, byte_offset=LONG, doc_id=LONG, piece=INT, n_tokens=INT, ids_crc32=LONG,
                    **({"ids": BINARY} if with_ids else {}))
    if start >= stop:
        return spark.createDataFrame([], schema)
    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path) \
        .where(F.col("shard").between(start // per_shard, (stop - 1) // per_shard)).select("content", "shard")  # as scanned: not copied

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                k = batch.column(1)[i].as_py()
                data = np.frombuffer(batch.column(0)[i].as_buffer(), np.uint8)
                base = k * per_shard
                count = min(per_shard, n - base)
                rows = np.arange(max(0, start - base), min(count, stop - base))
                own = data[:count * stride].reshape(count, stride)[rows[0]:rows[-1] + 1]
                name = own[:, 0:8].copy().view("<i8").reshape(-1)
                piece = own[:, 8:12].copy().view("<u4").reshape(-1)
                length = own[:, 12:16].copy().view("<u4").reshape(-1)
                body = [own[j, _HEAD:].view(kind)[:m].astype("<u4").tobytes() for j, m in enumerate(length.tolist())] if with_ids else None
                crc = [zlib.crc32(own[j, _HEAD:].view(kind)[:m].astype("<u4").tobytes()) for j, m in enumerate(length.tolist())]
                columns = [pa.array(base + rows, pa.int64()), pa.array(np.full(len(rows), k), pa.int32()),
                           pa.array(rows * stride, pa.int64()), pa.array(name, pa.int64(), mask=piece >= _NULL),
                           pa.array((piece & (_NULL - 1)).astype(np.int32)), pa.array(length.astype(np.int32)),
                           pa.array(crc, pa.int64())]
                yield pa.RecordBatch.from_arrays(columns + ([pa.array(body, pa.binary())] if with_ids else []), names=schema.names)

    return files.mapInArrow(read, schema)


def materialised(docs: DataFrame) -> DataFrame:
    """The documents' shards, written and read back in whole."""
    spark = docs.sparkSession
    path = run_dir(spark, "order") + "/shards"
    layout = write_shards(docs, path)
    return read_slots(spark, path, layout, with_ids=False)
