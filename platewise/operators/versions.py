"""Tables that are replaced whole and atomically: version folders and a pointer written last.

``<table>/_versions/<number>-...`` holds one complete version. A version counts from the moment its pointer, an empty
file ``<table>/_pointers/<number>__<folder>`` that is created exclusively, is there; readers take the highest number. A
job that ends between the two writes leaves a folder that nobody reads, and the old version stays readable. Of two jobs
that aim at one number the second fails. Old versions, and folders that never got a pointer, go when a later version is
published, the newest ``KEEP`` staying for readers that began before.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from ..session import remove_path

KEEP = 2
VERSIONS, POINTERS = "_versions", "_pointers"


@dataclass(frozen=True)
class Version:
    number: int
    folder: str

    @property
    def note(self) -> str:
        """What the writer put into the folder's name, between the number and the random part."""
        return self.folder.split("-")[1]


def _fs(spark: SparkSession, path: str):
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), where


def _names(spark: SparkSession, path: str) -> list[str]:
    fs, where = _fs(spark, path)
    return [f.getPath().getName() for f in fs.listStatus(where)] if fs.exists(where) else []


def pointed(spark: SparkSession, table: str) -> list[Version]:
    """The versions that have a pointer, oldest first."""
    found = [n.split("__", 1) for n in _names(spark, f"{table.rstrip('/')}/{POINTERS}") if "__" in n]
    return sorted((Version(int(n), folder) for n, folder in found), key=lambda v: v.number)


def current(spark: SparkSession, table: str) -> Version | None:
    return max(pointed(spark, table), key=lambda v: v.number, default=None)


def folder_of(table: str, version: Version) -> str:
    return f"{table.rstrip('/')}/{VERSIONS}/{version.folder}"


def planned(spark: SparkSession, table: str, note: str = "v") -> Version:
    """The next version, to be written to its folder and then pointed to."""
    last = current(spark, table)
    number = last.number + 1 if last else 1
    return Version(number, f"{number:08d}-{note}-{uuid.uuid4().hex[:12]}")


def point_to(spark: SparkSession, table: str, version: Version, keep: int = KEEP) -> None:
    """Make a complete version the current one, then remove old ones."""
    table = table.rstrip("/")
    if any(v.number >= version.number for v in pointed(spark, table)):
        raise RuntimeError(f"version {version.number} of {table} has been published by another job")
    fs, where = _fs(spark, f"{table}/{POINTERS}/{version.number:08d}__{version.folder}")
    fs.create(where, False).close()
    if [v for v in pointed(spark, table) if v.number == version.number] != [version]:
        fs.delete(where, False)
        raise RuntimeError(f"two jobs published version {version.number} of {table}")
    kept = pointed(spark, table)[-keep:]
    for folder in _names(spark, f"{table}/{VERSIONS}"):
        if int(folder.split("-")[0]) <= version.number and folder not in {v.folder for v in kept}:
            remove_path(spark, f"{table}/{VERSIONS}/{folder}")
    for old in pointed(spark, table)[:-keep]:
        remove_path(spark, f"{table}/{POINTERS}/{old.number:08d}__{old.folder}")


def publish(df: DataFrame, table: str, partition_by: list[str] | None = None, keep: int = KEEP) -> Version:
    """Replace the table by ``df``, which may read the table's current version."""
    version = planned(df.sparkSession, table)
    writer = df.hint("rebalance", *partition_by).write.partitionBy(*partition_by) if partition_by else df.write
    writer.parquet(folder_of(table, version))
    point_to(df.sparkSession, table, version, keep)
    return version


def read(spark: SparkSession, table: str) -> DataFrame:
    """The current version."""
    version = current(spark, table)
    if version is None:
        raise FileNotFoundError(f"no published version of {table}")
    return spark.read.parquet(folder_of(table, version))
