"""Small helpers shared by the operators of this subpackage."""

from __future__ import annotations

import atexit
import ctypes
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from platewise.session import storage_root

#: The ASCII bytes \x09-\x0D and \x20, which separate words.
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_P1, _P2, _P3 = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F), np.uint64(0x165667B19E3779F9))
_ROT, _REST = np.uint64(31), np.uint64(33)


def pick(df: DataFrame, *names: str, **renamed: str) -> DataFrame:
    """The named columns (``new=old`` renames), found by exact name, the first if several share it.

    Other columns may have any names, also ones that differ in case only.
    """
    at = [f"_c{i}" for i in range(len(df.columns))]
    wanted = {**{n: n for n in names}, **renamed}
    missing = [old for old in wanted.values() if old not in df.columns]
    if missing:
        raise ValueError(f"no column {missing[0]!r} in {df.columns}")
    return df.toDF(*at).select(*[F.col(at[df.columns.index(old)]).alias(new) for new, old in wanted.items()])


LONG, INT, DOUBLE, STRING, BINARY, BOOL = (
    T.LongType(), T.IntegerType(), T.DoubleType(), T.StringType(), T.BinaryType(), T.BooleanType())


def fields(**types: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(k, v) for k, v in types.items()])


def carry(df: DataFrame, *names: str, **renamed: str) -> DataFrame:
    """``row`` (a struct of all columns, by position) beside the columns an operator reads, found by exact name."""
    at = [f"_c{i}" for i in range(len(df.columns))]
    wanted = {**{n: n for n in names}, **renamed}
    missing = [old for old in wanted.values() if old not in df.columns]
    if missing:
        raise ValueError(f"no column {missing[0]!r} in {df.columns}")
    return df.toDF(*at).select(F.struct(*at).alias("row"),
                               *[F.col(at[df.columns.index(old)]).alias(new) for new, old in wanted.items()])


def restore(out: DataFrame, df: DataFrame, *extra: str) -> DataFrame:
    """Columns of ``df`` out of ``row``, then the operator's ``extra`` columns, which replace any of the same name."""
    new = {e.lower() for e in extra}
    return out.select(*[F.col(f"row._c{i}").alias(c) for i, c in enumerate(df.columns) if c.lower() not in new], *extra)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def run_dir(spark: SparkSession, name: str) -> str:
    """A new folder of this run in shared storage, removed when the driver's Python ends."""
    path = f"{storage_root(spark)}/llm/{name}-{uuid.uuid4().hex[:12]}"

    def remove() -> None:
        try:
            jvm = spark.sparkContext._jvm
            where = jvm.org.apache.hadoop.fs.Path(path)
            where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)
        except Exception:  # the session may be gone; the folder then stays with the cluster's own clean-up
            pass

    atexit.register(remove)
    return path


def materialise(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to shared storage and read back: one computation, no lineage, safe when executors are lost."""
    spark = df.sparkSession
    path = f"{run_dir(spark, name)}/{name}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def width(spark: SparkSession) -> int:
    """The session's shuffle width, which a cluster sizes by its data."""
    return max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))


def slices(batch: pa.RecordBatch, column: str, most: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """The batch in runs of rows with about ``most`` bytes of text each, one row at least."""
    size = np.asarray(pa.compute.binary_length(batch.column(column)).fill_null(0), dtype=np.int64)
    total = np.cumsum(size)
    at = 0
    while at < batch.num_rows:
        base = total[at - 1] if at else 0
        end = max(at + 1, int(np.searchsorted(total, base + most, side="right")))
        yield batch.slice(at, end - at)
        at = end


def pack(values: np.ndarray) -> bytes:
    """Integers as compressed byte planes."""
    flat = np.ascontiguousarray(values)
    planes = flat.view(np.uint8).reshape(-1, flat.itemsize).T if flat.size else flat.view(np.uint8)
    return zstandard.ZstdCompressor(level=1).compress(np.ascontiguousarray(planes).tobytes())


def unpack(data: bytes, dtype) -> np.ndarray:
    raw = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), dtype=np.uint8)
    size = np.dtype(dtype).itemsize
    return np.ascontiguousarray(raw.reshape(size, -1).T).reshape(-1).view(dtype)


def give_back() -> None:
    """Returns freed memory to the system at the end of a task: a Python worker lives on beside the JVM between tasks."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):  # another C library than glibc
        pass


def mix(h: np.ndarray) -> np.ndarray:
    """A bijective scramble of 64-bit values."""
    h = h ^ (h >> _REST)
    h = h * _P2
    h = h ^ (h >> np.uint64(29))
    h = h * _P3
    return h ^ (h >> np.uint64(32))


def word_hashes(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, bytes, np.ndarray, np.ndarray]:
    """64-bit hashes of all words ``[^\\x20\\x09-\\x0D]+`` of the A-Z lower-cased texts.

    Returns the hashes in order, the number of words per text, the lower-cased texts joined by spaces,
    and each word's start and end in it. Words are read eight bytes at a time, vectorised over all words.
    """
    joined = b" ".join(texts).lower()
    buf = np.frombuffer(joined + b" " * 9, dtype=np.uint8)
    space = _SPACE[buf]
    edge = np.flatnonzero(space[1:] != space[:-1]) + 1
    if not space[0]:
        edge = np.concatenate([[0], edge])
    starts, ends = edge[0::2], edge[1::2]
    sizes = np.array([len(t) for t in texts], dtype=np.int64)
    last = np.cumsum(sizes + 1)  # a text and the space behind it
    n_words = np.diff(np.searchsorted(starts, last), prepend=0)
    length = (ends - starts).astype(np.uint64)
    eight = np.ndarray(shape=(len(buf) - 7,), dtype="<u8", buffer=buf.data, strides=(1,))
    h = length * _P1
    left, where, pos = length.astype(np.int64), np.arange(len(starts)), starts.copy()
    with np.errstate(over="ignore"):
        while len(where):
            v = eight[pos]
            short = left < 8
            keep = np.where(short, left, 8).astype(np.uint64) * np.uint64(8)
            v = np.where(short, v & ((np.uint64(1) << (keep % np.uint64(64))) - np.uint64(1)), v)
            x = v * _P2
            x = ((x << _ROT) | (x >> _REST)) * _P1
            g = h[where] ^ x
            h[where] = ((g << np.uint64(27)) | (g >> np.uint64(37))) * _P1 + _P3
            more = left > 8
            where, pos, left = where[more], pos[more] + 8, left[more] - 8
        h = mix(h)
    return h, n_words, joined, starts, ends


def texts_of(column: pa.Array) -> list[bytes]:
    """UTF-8 bytes of a string column; null is empty."""
    return column.cast(pa.binary()).fill_null(b"").to_pylist()


def crc_mod(doc_id: str, n: int):
    """crc32 of the id as text, modulo ``n`` (Spark); null ids count as empty text."""
    return F.pmod(F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).cast("binary")), F.lit(n))
