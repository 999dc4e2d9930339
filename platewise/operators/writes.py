"""Write patterns: landing (A1-A3), full refresh (A8), incremental (I1/I2),
SCD2 snapshots (I4) and point-in-time reads (I5).

Tables are parquet folders under the shared storage root (see
``platewise.session.storage_root``). A write never overwrites a path that
the same plan reads: merges and snapshots are first written complete to a
sibling staging folder, then copied over. A full refresh overwrites the whole
table (*static* mode, whatever the session's default), so no stale partition
stays behind; merges use *dynamic* overwrite, so only the touched partitions
are replaced. Each step is a plain Spark write, so lost executors are handled
by task retry, and the staged folder cuts the lineage of long incremental
chains. The staged copy is removed after a good write; if the final copy itself
fails, the staged copy (kept under ``<table>__staging/``) is the complete new
version to copy back. Tables that are replaced whole, and the open rows of
snapshots, are versions with a pointer instead (``operators.versions``): their
replacement is atomic.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..session import remove_path, scratch_dir
from . import versions as V


# ------------------------------------------------------------------ helpers
ABSENT_CONDITIONS = {"PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"}


def table_exists(spark: SparkSession, path: str) -> bool:
    """True when ``path`` holds a readable parquet table.

    Only "no such path" and "no data files" count as absent; any other error
    (permissions, a flaky store) is raised, so an incremental run can never
    mistake an unreadable target for a first build and overwrite it.
    """
    try:
        spark.read.parquet(path).schema  # noqa: B018 - metadata only
        return True
    except AnalysisException as e:
        if (e.getCondition() or "") in ABSENT_CONDITIONS:
            return False
        raise


def _writer(df: DataFrame, mode: str, partition_by: list[str] | None, overwrite: str = "static"):
    if not partition_by:
        return df.write.mode(mode)
    # REBALANCE: AQE clusters rows by the partition columns (few files per
    # partition) but splits a hot partition value over several tasks
    return (df.hint("rebalance", *partition_by).write.mode(mode).option("partitionOverwriteMode", overwrite)
            .partitionBy(*partition_by))


@contextmanager
def staged(df: DataFrame, path: str, partition_by: list[str] | None = None) -> Iterator[DataFrame]:
    """Materialise ``df`` beside ``path`` and give a frame reading it back.

    The copy is removed when the block ends well, and kept when it fails."""
    spark = df.sparkSession
    tmp = f"{path.rstrip('/')}__staging/{uuid.uuid4().hex}"
    _writer(df, "overwrite", partition_by).parquet(tmp)
    yield spark.read.schema(df.schema).parquet(tmp)
    remove_path(spark, tmp)


def _swap_partitions(new: DataFrame, path: str, partition_by: list[str]) -> None:
    """Replace the partitions present in ``new`` (dynamic overwrite); others stay."""
    _writer(new, "overwrite", partition_by, overwrite="dynamic").parquet(path)


# ------------------------------------------------------------ A1 - A3, A8
def land_food_pages(pages: DataFrame, loaded_at: Column | str | None = None,
                    payload_col: str = "payload") -> DataFrame:
    """A1: API pages (a JSON array of food objects per row) -> raw_foods rows.

    Each object is kept as received (JSON text); ``fdc_id`` is read from it;
    ``loaded_at`` defaults to the load time. Pages that are no arrays give no
    rows here; ``landing.load_food_pages`` keeps them in a quarantine.
    """
    ts = F.current_timestamp() if loaded_at is None else (
        F.to_timestamp(F.lit(loaded_at)) if isinstance(loaded_at, str) else loaded_at)
    docs = pages.select(F.explode(F.from_json(F.col(payload_col), "array<string>")).alias("raw_json"))
    return docs.select(F.get_json_object("raw_json", "$.fdcId").cast("long").alias("fdc_id"),
                       ts.alias("loaded_at"), "raw_json")


def read_food_pages(spark: SparkSession, path: str) -> DataFrame:
    """A1 source: one landed page file per row (whole-file text), with the file's path."""
    return spark.read.text(path, wholetext=True).select(F.col("value").alias("payload"), F.col("_metadata.file_path").alias("file"))


def append_table(df: DataFrame, path: str, partition_by: list[str] | None = None) -> None:
    """A1/A3: append-only load (not idempotent by design)."""
    _writer(df, "append", partition_by).parquet(path)


def replace_table(df: DataFrame, path: str, partition_by: list[str] | None = None) -> None:
    """Full refresh. ``df`` must not read ``path`` (use ``merge_by_key``)."""
    _writer(df, "overwrite", partition_by).parquet(path)


# ------------------------------------------------------------------ I1 / I2
def high_water_mark(spark: SparkSession, path: str, col: str) -> Column:
    """Scalar subquery: max(col) of the whole target (partition metadata when
    ``col`` is a partition column)."""
    return spark.read.parquet(path).select(F.max(col)).scalar()


def above(value: Column, mark: Column) -> Column:
    """Whether a row is newer than the mark; a target without rows has no mark, and everything is newer."""
    return mark.isNull() | (value > mark)


def incremental_append(batch: DataFrame, path: str, watermark_col: str,
                       partition_by: list[str] | None = None) -> None:
    """I1 (reference mode): keep batch rows strictly above the target's
    high-water mark; an absent or empty target gets the whole batch.

    Rows at or below the mark are dropped (late data is lost, like the
    warehouse). Because kept rows are newer than every target row, a key
    can only collide inside the batch, so the write is a plain append.
    """
    spark = batch.sparkSession
    if not table_exists(spark, path):
        replace_table(batch, path, partition_by)
        return
    mark = high_water_mark(spark, path, watermark_col)
    append_table(batch.where(above(F.col(watermark_col), mark)), path, partition_by)


def touched_partitions(target: DataFrame, batch: DataFrame, partition_by: list[str]) -> DataFrame:
    """The target's rows in the partitions that ``batch`` touches.

    The range between the batch's smallest and largest value of each partition
    column (scalar subqueries) is a partition filter, so other folders are not
    read; the semi-join then leaves the exact set."""
    for c in partition_by:
        span = batch.select(F.struct(F.min(c).alias("lo"), F.max(c).alias("hi"))).scalar()
        target = target.where((F.col(c) >= span["lo"]) & (F.col(c) <= span["hi"]))
    return target.join(batch.select(*partition_by).distinct(), partition_by, "left_semi")


def merge_by_key(batch: DataFrame, path: str, unique_key: list[str], partition_by: list[str] | None = None) -> None:
    """I2 (reprocess mode): delete target rows whose key is in the batch, insert the batch.

    Duplicates inside the batch are kept (delete+insert semantics). With a
    partitioned target only the partitions from the batch's first to its last
    are read; those it touches are rewritten via a staged copy and swapped in
    with dynamic overwrite.
    """
    spark = batch.sparkSession
    if not table_exists(spark, path):
        replace_table(batch, path, partition_by)
        return
    # the batch is used several times below: materialise it once (shared storage,
    # survives executor loss, cuts the batch's lineage)
    with staged(batch, path) as fresh:
        if fresh.isEmpty():
            return
        target = spark.read.parquet(path)
        if partition_by:
            target = touched_partitions(target, fresh, partition_by)
        keys = fresh.select(*unique_key).distinct()
        merged = target.join(keys, unique_key, "left_anti").unionByName(fresh.select(*target.columns))
        with staged(merged, path, partition_by) as new:
            if partition_by:
                _swap_partitions(new, path, partition_by)
            else:
                new.write.mode("overwrite").parquet(path)


def replace_partitions(batch: DataFrame, path: str, partition_by: list[str],
                       values: list[str] | None = None) -> None:
    """Reprocess mode by date: the partitions present in ``batch`` are replaced
    whole (staged first, then dynamic partition overwrite); others untouched.

    ``values`` names all partitions (of the one partition column, as written in
    folder names) that the batch stands for: those of them that the batch has
    no rows for are cleared. Recomputing given days from raw this way also
    recovers rows that the strict high-water mark dropped as late.
    """
    spark = batch.sparkSession
    if not table_exists(spark, path):
        replace_table(batch, path, partition_by)
        return
    with staged(batch, path, partition_by) as new:
        if not new.isEmpty():
            _swap_partitions(new, path, partition_by)
        if values:
            column, = partition_by
            # at most one row per named partition reaches the driver
            there = {str(r[0]) for r in new.select(F.col(column).cast("string")).distinct().collect()}
            for v in set(values) - there:
                remove_path(spark, f"{path.rstrip('/')}/{column}={v}")


# ------------------------------------------------------------------ I4 / I5
SCD_COLS = ["dbt_scd_id", "dbt_updated_at", "dbt_valid_from", "dbt_valid_to"]


# The physical partition of a closed snapshot row: the run that closed it.
SCD_PART, OPEN = "dbt_closed_run", "open"


def _scd_new(rows: DataFrame, key: str, run_ts: Column) -> DataFrame:
    return rows.select(
        "*",
        snapshot_key(F.col(key), run_ts).alias("dbt_scd_id"),
        run_ts.alias("dbt_updated_at"),
        run_ts.alias("dbt_valid_from"),
        F.lit(None).cast("timestamp_ntz").alias("dbt_valid_to"),
    )


def snapshot_key(*cols: Column) -> Column:
    """md5 of the '|'-joined string forms, NULL as empty text (the public snapshot macro's hash)."""
    return F.md5(F.concat_ws("|", *[F.coalesce(c.cast("string"), F.lit("")) for c in cols]))


def snapshot_joined(current: DataFrame, source: DataFrame, unique_key: str, check_cols: list[str]) -> DataFrame:
    """I4 core: open rows beside the source's row of their key (``_s_`` columns, full outer join), with ``_here`` (there is
    an open row) and ``_new`` (it has no successor in the source that differs in a check column, NULL-safe)."""
    s = source.select(*[F.col(c).alias(f"_s_{c}") for c in source.columns], F.lit(True).alias("_there"))
    j = current.withColumn("_here", F.lit(True)).join(s, current[unique_key] == s[f"_s_{unique_key}"], "full_outer")
    changed = F.lit(False)
    for c in check_cols:
        changed = changed | ~F.col(c).eqNullSafe(F.col(f"_s_{c}"))
    here = F.coalesce("_here", F.lit(False))
    return j.withColumn("_here", here).withColumn("_changed", here & F.coalesce("_there", F.lit(False)) & changed)


def snapshot_rows(joined: DataFrame, columns: list[str], unique_key: str, run_ts: Column) -> tuple[DataFrame, DataFrame]:
    """(open rows, rows closed by this run): open rows whose check columns differ are closed at ``run_ts`` and a new open
    version takes their place; new keys are added; keys missing from the source stay open (hard deletes are ignored)."""
    stays = F.col("_here") & ~F.col("_changed")
    fresh = {"dbt_scd_id": snapshot_key(F.col(f"_s_{unique_key}"), run_ts), "dbt_updated_at": run_ts, "dbt_valid_from": run_ts,
             "dbt_valid_to": F.lit(None).cast("timestamp_ntz")}
    opened = joined.select(*[F.when(stays, F.col(c)).otherwise(F.col(f"_s_{c}")).alias(c) for c in columns],
                           *[F.when(stays, F.col(c)).otherwise(v).alias(c) for c, v in fresh.items()])
    closed = joined.where("_changed").select(*columns, "dbt_scd_id", "dbt_updated_at", "dbt_valid_from", run_ts.alias("dbt_valid_to"))
    return opened, closed


def snapshot_check(source: DataFrame, path: str, unique_key: str, check_cols: list[str],
                   run_ts: str | Column) -> None:
    """I4: SCD2 'check' snapshot of ``source`` into ``path`` at ``run_ts``.

    First run: every row open from ``run_ts``. Later runs: see ``snapshot_rows``. The open rows are a version
    (``operators.versions``) bucketed by key; the source is computed once, into the same buckets, so that neither the
    test for repeated keys (refused) nor the join with the open rows moves a row of either. The rows that a run closes
    go to a partition of their own; the pointer to the new open rows, written last, names the run, and readers leave out
    closed rows of later ones: a run that ends early changes nothing, and is repeated as if it had not been.
    """
    spark = source.sparkSession
    ts = F.lit(run_ts).cast("timestamp_ntz") if isinstance(run_ts, str) else run_ts
    run = spark.range(1).select(F.date_format(ts, "yyyyMMddHHmmssSSSSSS")).first()[0]
    last = V.current(spark, path)
    buckets = int(last.note.split("x")[1]) if last else int(spark.conf.get("spark.sql.shuffle.partitions"))
    loaded = scratch_dir(spark, "snapshot-source")
    write_buckets(source.repartition(buckets, unique_key), loaded, unique_key, buckets)
    with bucket_table(spark, loaded, source.schema, unique_key, buckets) as src:
        if not src.groupBy(unique_key).agg(F.count(F.lit(1)).alias("n")).where("n > 1").isEmpty():
            raise ValueError(f"several source rows of one {unique_key}: a snapshot needs one row per key")
        version = V.planned(spark, path, f"{run}x{buckets}")
        if last is None:
            write_buckets(_scd_new(src, unique_key, ts), V.folder_of(path, version), unique_key, buckets)
        else:
            folder = V.folder_of(path, last)
            with bucket_table(spark, folder, spark.read.parquet(folder).schema, unique_key, buckets) as current:
                joined = snapshot_joined(current, src, unique_key, check_cols)
                opened, closed = snapshot_rows(joined, source.columns, unique_key, ts)
                # rows left by a run that ended early are written over; those of a finished one are kept
                mode = "append" if last.note.split("x")[0] == run else "overwrite"
                if not closed.isEmpty():
                    closed.write.mode(mode).parquet(f"{path.rstrip('/')}/{SCD_PART}={run}")
                write_buckets(opened, V.folder_of(path, version), unique_key, buckets)
        V.point_to(spark, path, version)
    remove_path(spark, loaded)


def write_buckets(df: DataFrame, folder: str, key: str, buckets: int) -> None:
    """Write a frame that is dealt by the hash of ``key`` to ``buckets`` files."""
    name = f"platewise_{uuid.uuid4().hex}"
    df.write.format("parquet").bucketBy(buckets, key).sortBy(key).option("path", folder).saveAsTable(name)
    df.sparkSession.sql(f"DROP TABLE {name}")  # the files of a table with a path stay


@contextmanager
def bucket_table(spark: SparkSession, folder: str, schema: StructType, key: str, buckets: int) -> Iterator[DataFrame]:
    """A folder of buckets as a table whose layout the planner knows, until the block ends."""
    name = f"platewise_{uuid.uuid4().hex}"
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
    spark.sql(f"CREATE TABLE {name} ({columns}) USING parquet CLUSTERED BY ({key}) SORTED BY ({key}) INTO {buckets} BUCKETS "
              f"LOCATION '{folder}'")
    try:
        yield spark.table(name)
    finally:
        spark.sql(f"DROP TABLE {name}")


def read_snapshot(spark: SparkSession, path: str) -> DataFrame:
    """All versions of all keys: the open rows of the last finished run and what runs up to it closed."""
    last = V.current(spark, path)
    opened = spark.read.parquet(V.folder_of(path, last))
    if not table_exists(spark, path):
        return opened
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in opened.schema.fields)
    closed = spark.read.schema(f"{columns}, {SCD_PART} string").parquet(path).where(F.col(SCD_PART) <= last.note.split("x")[0])
    return opened.unionByName(closed.drop(SCD_PART))


def as_of(snapshot: DataFrame, t: str | Column) -> DataFrame:
    """The version of every key that was valid at time ``t``."""
    tc = F.lit(t).cast("timestamp_ntz") if isinstance(t, str) else t
    return snapshot.where((F.col("dbt_valid_from") <= tc)
                          & (F.col("dbt_valid_to").isNull() | (tc < F.col("dbt_valid_to"))))
