"""X1 with state: daily intake from a stream, with a watermark, late rows apart, and a sink of bounded size.

The chain of ``meal_stream`` up to the scaled items; then each micro-batch, in one ``foreachBatch``:

* The watermark is the newest day of the batches before, less ``delay_days``. Rows of earlier days are late: they go to a
  side table, added up per user and day, and are counted.
* The other rows' exact sums are merged into the state, one row per user and open day (keyed like the windows of an
  event-time aggregate). Days before the new watermark can get no more rows: they leave the state for the table of closed
  days, where they are written once and never touched again.
* State, closed days and late sums of a batch are written under its number, and the state's pointer
  (``operators.versions``), written last and naming the batch, makes them count: a batch that is replayed after a failure
  does nothing if the pointer has its number, and writes over its own folders otherwise.

What grows with the stream is the closed days' table, one row per user and day. Its small folders, one per batch, are
folded in tiers: ``FOLD`` of one tier become one of the next, so there are at most ``FOLD`` folders per tier and a row is
written again once per tier. ``read_daily`` adds closed, open and late sums up: the answer equals the batch one for any
order of files. The state is a table, not Spark's state store, because that drops late rows without a trace.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schemas
from ..operators import staging as S
from ..operators import transforms as T
from ..operators import versions as V
from ..operators import writes as W
from ..session import remove_path

FOLD = 8
KINDS = ("closed", "late")


def _sums(rows: DataFrame) -> DataFrame:
    return T.grouped_grams(rows, T.DAY_KEYS)


def _note(spark: SparkSession, sink: str) -> tuple[int, str | None]:
    """(last batch that counts, newest day seen), from the name of the state's current version."""
    last = V.current(spark, f"{sink}/state")
    if last is None:
        return -1, None
    batch, day = last.note.split("x")
    return int(batch), (f"{day[:4]}-{day[4:6]}-{day[6:]}" if day != "none" else None)


def _parts(spark: SparkSession, sink: str, kind: str) -> list[tuple[int, int, str]]:
    """(tier, last batch, folder) of the finished folders of a kind: later batches' are of unfinished ones."""
    done = _note(spark, sink)[0]
    found = [n for n in V._names(spark, f"{sink}/{kind}") if n.startswith("t")]
    parsed = sorted((int(n[1:].split("-")[0]), int(n.split("-")[1]), f"{sink}/{kind}/{n}") for n in found)
    # a folded folder replaces the lower tiers' folders up to its batch, also where these could not be removed any more
    upto = {t: max((b for u, b, _ in parsed if u > t), default=-1) for t, _, _ in parsed}
    return [(t, b, p) for t, b, p in parsed if b <= done and b > upto[t]]


def _fold(spark: SparkSession, sink: str, kind: str) -> None:
    """Fold ``FOLD`` folders of a tier into one of the next tier, as often as there are as many."""
    while True:
        parts = _parts(spark, sink, kind)
        tiers = {t: [(b, p) for u, b, p in parts if u == t] for t, _, _ in parts}
        full = next((t for t in sorted(tiers) if len(tiers[t]) >= FOLD), None)
        if full is None:
            return
        last = max(b for b, _ in tiers[full])
        rows = spark.read.parquet(*[p for _, p in tiers[full]])
        target = f"{sink}/{kind}/t{full + 1}-{last:012d}"
        # complete before it has its name
        _sums(rows).write.mode("overwrite").parquet(f"{sink}/{kind}/_folding")
        fs, where = V._fs(spark, f"{sink}/{kind}/_folding")
        fs.rename(where, V._fs(spark, target)[1])
        for _, p in tiers[full]:
            remove_path(spark, p)


def merge_batch(sink: str, delay_days: int):
    """The ``foreachBatch`` function."""
    def run(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        done, newest = _note(spark, sink)
        if batch_id <= done:
            return
        with W.staged(_sums(batch), f"{sink}/batch") as sums:
            seen = sums.agg(F.max("logged_date").cast("string")).first()[0]
            mark = F.date_sub(F.lit(newest).cast("date"), delay_days) if newest else F.lit("0001-01-01").cast("date")
            latest = max(filter(None, (newest, seen)), default=None)
            late, fresh = sums.where(F.col("logged_date") < mark), sums.where(F.col("logged_date") >= mark)
            state = fresh if done < 0 else _sums(fresh.unionByName(V.read(spark, f"{sink}/state")))
            version = V.planned(spark, f"{sink}/state", f"{batch_id}x{latest.replace('-', '') if latest else 'none'}")
            closing = F.col("logged_date") < (F.date_sub(F.lit(latest).cast("date"), delay_days) if latest else mark)
            for kind, rows in (("late", late), ("closed", state.where(closing))):
                rows.write.mode("overwrite").parquet(f"{sink}/{kind}/t0-{batch_id:012d}")
            state.where(~closing).write.parquet(V.folder_of(f"{sink}/state", version))
            V.point_to(spark, f"{sink}/state", version)
        for kind in KINDS:
            _fold(spark, sink, kind)
    return run


def run_daily_intake(spark: SparkSession, landing: str, foods: DataFrame, sink: str, checkpoint: str, tz: str = "UTC",
                     delay_days: int = 2, max_files_per_trigger: int | None = None, available_now: bool = True):
    """Start (and, with ``available_now``, finish) the stream; returns the query. ``foods`` is read in every micro-batch."""
    reader = spark.readStream.schema(schemas.RAW_MEAL_LOGS)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    items = T.meal_items(S.stg_meal_logs(reader.parquet(landing), tz))
    writer = T.scaled_exact(items, foods).writeStream.outputMode("append").option("checkpointLocation", checkpoint).foreachBatch(
        merge_batch(sink.rstrip("/"), delay_days))
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="1 minute")
    q = writer.start()
    if available_now:
        q.awaitTermination()
    return q


def _read(spark: SparkSession, sink: str, kind: str) -> DataFrame:
    state = V.read(spark, f"{sink}/state")
    paths = [p for _, _, p in _parts(spark, sink, kind)]
    return spark.read.schema(state.schema).parquet(*paths) if paths else state.limit(0)


def read_daily(spark: SparkSession, sink: str) -> DataFrame:
    """Daily grams per user and nutrient so far: closed and open days, and what came late."""
    sink = sink.rstrip("/")
    rows = V.read(spark, f"{sink}/state")
    for kind in KINDS:
        rows = rows.unionByName(_read(spark, sink, kind))
    return T.daily_long(_sums(rows))


def read_late(spark: SparkSession, sink: str) -> DataFrame:
    """The side table: sums per user and day of rows that came behind the watermark."""
    return _sums(_read(spark, sink.rstrip("/"), "late"))
