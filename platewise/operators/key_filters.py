"""Q2/Q4/Q8 over new rows only: a Bloom filter of the keys beside each stored partition.

Whether the keys of a new load are already stored is asked of the filters first: they tell which old partitions a key can
lie in (about one in 25 million of the keys that are not there is told wrongly), and only those partitions are read for the
exact answer. A filter has a power of two of bits, at least ``BITS`` per key, and is kept as blocks of 32,768 bits, so no
partition's filter is gathered in one value however many keys it has. All bits of a key lie in one block, so a key is dealt
out once per filter size and asked of a block of each partition there; what leaves that step are the candidates, not a row
per key and partition. A key that half the new rows share is asked once, and the keys of a block are asked in packs, so
that few blocks and a large load are as many tasks as the load needs.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, LongType, StructField, StructType

from ..session import scratch_dir

HASHES, BITS = 8, 64
_BLOCK = _LEAST = 32_768
#: New keys asked at once; stored keys set at once, and blocks laid out at once.
PACK, HELD, _SLAB = 1 << 16, 1 << 20, 256


def _block(key: Column, size: Column) -> Column:
    return F.pmod(F.xxhash64(key, F.lit(0)), F.call_function("div", size, F.lit(_BLOCK)))


def _hashes(key: Column) -> list[Column]:
    """The places of a key's bits in its block: 15 bits each, four in ``_a`` and four in ``_b``."""
    return [F.xxhash64(key, F.lit(1)).alias("_a"), F.xxhash64(key, F.lit(2)).alias("_b")]


def _places(a: np.ndarray, b: np.ndarray) -> list[np.ndarray]:
    return [(h >> (15 * k)) & (_BLOCK - 1) for h in (a, b) for k in range(HASHES // 2)]


def _set_bits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Blocks with the bits of some of their keys."""
    held, rows = [], 0
    for batch in batches:
        held.append(batch)
        rows += batch.num_rows
        if rows >= HELD:
            yield from _laid_out(pa.Table.from_batches(held))
            held, rows = [], 0
    if rows:
        yield from _laid_out(pa.Table.from_batches(held))


def _laid_out(rows: pa.Table) -> Iterator[pa.RecordBatch]:
    coded = rows.column("part").combine_chunks().dictionary_encode()
    part = coded.indices.to_numpy(zero_copy_only=False)
    size, block, a, b = (rows.column(c).to_numpy() for c in ("size", "block", "_a", "_b"))
    order = np.lexsort((block, part))
    part, size, block, a, b = (x[order] for x in (part, size, block, a, b))
    new = np.ones(len(order), bool)
    new[1:] = (part[1:] != part[:-1]) | (block[1:] != block[:-1])
    first = np.flatnonzero(new)
    ends = np.append(first, len(order))
    rank = np.cumsum(new) - 1
    for at in range(0, len(first), _SLAB):
        there = first[at:at + _SLAB]
        own = slice(there[0], ends[min(at + _SLAB, len(first))])
        bits = np.zeros(len(there) * _BLOCK, np.uint8)
        base = (rank[own] - at) * _BLOCK
        for place in _places(a[own], b[own]):
            bits[base + place] = 1
        packed = np.packbits(bits, bitorder="little").reshape(len(there), -1)
        yield pa.RecordBatch.from_arrays(
            [coded.dictionary.take(pa.array(part[there])), pa.array(size[there]), pa.array(block[there]),
             pa.array([x.tobytes() for x in packed], pa.binary())], names=["part", "size", "block", "bits"])


def filters_of(rows: DataFrame, part: str, key: str) -> DataFrame:
    """``part``, ``size`` (bits), ``block`` and ``bits`` of the blocks of each partition's keys (NULL keys are left out)."""
    there = rows.where(F.col(key).isNotNull()).select(F.col(part).alias("part"), F.col(key).alias("key"))
    sizes = there.groupBy("part").agg(F.count(F.lit(1)).alias("n")).select(
        F.col("part").alias("_part"), F.greatest(F.lit(_LEAST), F.pow(F.lit(2.0), F.ceil(F.log2(F.col("n") * BITS)))).cast("long").alias("size"))
    # one row per partition
    placed = there.join(F.broadcast(sizes), F.col("part") == F.col("_part")).select(
        "part", "size", _block(F.col("key"), F.col("size")).alias("block"), *_hashes(F.col("key")))
    schema = StructType([StructField("part", there.schema["part"].dataType), StructField("size", LongType()),
                         StructField("block", LongType()), StructField("bits", BinaryType())])
    return placed.mapInArrow(_set_bits, schema).groupBy("part", "size", "block").agg(F.bitmap_or_agg("bits").alias("bits"))


def write_filters(rows: DataFrame, path: str, part: str, key: str) -> None:
    """Keep the filters of newly stored partitions (whole partitions: their filters are replaced)."""
    filters_of(rows, part, key).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("part").parquet(path)


def _asked(keys: pa.Table, blocks: pa.Table) -> pa.Table:
    """A pack of keys against one block of each partition: the keys with all bits set there."""
    places = _places(*(keys.column(c).to_numpy() for c in ("_a", "_b")))
    which, where = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    for p, bits in enumerate(blocks.column("bits") if keys.num_rows else ()):
        there = np.unpackbits(np.frombuffer(bits.as_buffer(), np.uint8), bitorder="little")
        left = np.flatnonzero(there[places[0]])
        for place in places[1:]:
            left = left[there[place[left]] == 1]
        which.append(left)
        where.append(np.full(len(left), p))
    return pa.table({"key": keys.column("key").take(pa.array(np.concatenate(which))),
                     "part": blocks.column("part").take(pa.array(np.concatenate(where)))})


def candidates(keys: DataFrame, key: str, filters: DataFrame) -> DataFrame:
    """(``key``, ``part``): each distinct key with the partitions that its bits are set in."""
    there = keys.where(F.col(key).isNotNull()).select(F.col(key).alias("key"))
    sizes = filters.select(F.collect_set("size").alias("s")).scalar()  # powers of two
    packs = there.select(F.count(F.lit(1)).alias("n")).scalar()
    # a size's blocks hold the same number of distinct keys each, by their hash
    of = lambda size: F.greatest(F.lit(1), F.ceil(packs / (size / F.lit(_BLOCK)) / F.lit(PACK)).cast("long"))
    asked = there.distinct().select("key", F.explode(sizes).alias("size"), *_hashes(F.col("key"))).select(
        "*", _block(F.col("key"), F.col("size")).alias("block"), F.pmod("_a", of(F.col("size"))).alias("pack"))
    met = filters.select("part", "size", "block", "bits", F.explode(F.sequence(F.lit(0).cast("long"), of(F.col("size")) - 1)).alias("pack"))
    at = ["size", "block", "pack"]
    schema = StructType([StructField("key", there.schema["key"].dataType), StructField("part", filters.schema["part"].dataType)])
    return asked.groupBy(*at).cogroup(met.groupBy(*at)).applyInArrow(lambda k, b: _asked(k, b), schema)


def stored_duplicates(spark: SparkSession, batch: DataFrame, table: str, filters: str, part: str, key: str) -> DataFrame:
    """The stored rows of keys that ``batch`` holds too: ``key``, ``part``, ``stored`` (rows there). Other partitions than
    those that the filters name are not read. Their names (as many as there are partitions at most) reach the driver."""
    path = scratch_dir(spark, "candidates")
    candidates(batch, key, spark.read.parquet(filters)).write.parquet(path)
    named = spark.read.parquet(path)
    parts = [r[0] for r in named.select("part").distinct().collect()]
    rows = spark.read.parquet(table).where(F.col(part).isin(parts)).select(F.col(key).alias("key"), F.col(part).alias("part"))
    wanted = named.select(F.col("key").alias("_key")).distinct()
    return rows.join(wanted, F.col("key") == F.col("_key"), "left_semi").groupBy("key", "part").agg(F.count(F.lit(1)).alias("stored"))
