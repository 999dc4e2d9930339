"""The daily build as a Spark job: materialise the star schema under a root folder.

What the warehouse's daily build does, as plain writes (no scheduler): the
dimensions are rebuilt (full refresh, swapped by a pointer), the four facts are appended above their
high-water marks (A9/I1), then the windowed snapshot is rebuilt from the
nutrient fact on disk, and the food dimension is snapshotted (SCD2, I4). The
lowest high-water mark of the facts is applied to the raw logs before anything
else is computed, so a daily run computes the new days only. Facts are
partitioned by their date, so reports reading the persisted marts prune
partitions, and high-water marks are partition-column maxima. ``build_changed_days`` is the other mode: it finds late
and corrected days by their sums and rebuilds those only. Every step is an
ordinary Spark write to the shared root: a lost executor only re-runs tasks,
and a re-run of the whole job skips what the high-water marks already hold.
"""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import late as L
from ..operators import versions as V
from ..operators import writes as W
from ..operators.transforms import NUTRIENTS
from .build import Warehouse

FACTS = {
    # name: (watermark column, partition columns)
    "fct_meal_logs": ("logged_date", ["logged_date"]),
    "fct_meal_log_nutrients": ("logged_date", ["logged_date"]),
    "fct_bmi_evolution": ("recorded_date_id", ["recorded_date_id"]),
    "fct_user_segments": ("logged_date", ["logged_date"]),
}
DIMENSIONS = ["dim_users", "dim_foods", "dim_meals", "dim_nutrients", "dim_date"]
REBUILT = ["fct_user_segments_windowed"]


ALL_MARTS = DIMENSIONS + REBUILT + list(FACTS) + ["dim_foods_snapshot"]


# facts computed from the meal logs
FROM_LOGS = ["fct_meal_logs", "fct_meal_log_nutrients", "fct_user_segments"]


def _as_written(column: str, days: list[str]) -> list[str]:
    """ISO days as the partition column holds them; ``*_date_id`` columns hold YYYYMMDD integers."""
    return [d.replace("-", "") if column.endswith("_id") else d for d in days]


def _on_days(df: DataFrame, column: str, days: list[str]) -> DataFrame:
    return df.where(F.col(column).cast("string").isin(_as_written(column, days)))


def lowest_mark(spark: SparkSession, root: str, names: list[str]) -> Column | None:
    """The earliest of the facts' high-water marks (scalar subqueries); None if one has to be built first."""
    paths = [(f"{root}/{n}", FACTS[n][0]) for n in names]
    if not paths or not all(W.table_exists(spark, p) for p, _ in paths):
        return None
    marks = [W.high_water_mark(spark, p, c) for p, c in paths]
    lowest = marks[0]
    for m in marks[1:]:  # NULL, a fact without rows, is the lowest of all
        lowest = F.when(lowest.isNotNull() & m.isNotNull(), F.least(lowest, m))
    return lowest


def build_marts(w: Warehouse, root: str, run_ts: str, full_refresh: bool = False,
                select: list[str] | None = None, reprocess_dates: list[str] | None = None) -> dict[str, str]:
    """Run one build of the selected marts (default: all) into ``root``.

    Returns {mart: path}. When several marts are built, the upstream models
    they share are written once first. ``reprocess_dates`` (ISO dates)
    switches the facts from the high-water-mark append to replacing exactly
    those days, recomputed from raw (late data recovered, days that have
    become empty cleared).
    """
    spark, root = w.spark, root.rstrip("/")
    chosen = [m for m in ALL_MARTS if select is None or m in select]
    logs = [m for m in FROM_LOGS if m in chosen]
    mark = None if full_refresh or reprocess_dates else lowest_mark(spark, root, logs)
    new = w if mark is None else w.after(mark)
    if len(chosen) > 1:
        w.materialize("food_nutrients", "stg_users", "stg_weights").materialize("users_bmi")
        for shared in ("food_nutrients", "stg_users", "stg_weights", "users_bmi"):
            new.__dict__[shared] = w.__dict__[shared]
        if len(logs) > 1:
            new.materialize("items").materialize("scaled_exact")
    paths = {name: f"{root}/{name}" for name in chosen}
    for name in [*[m for m in chosen if m in DIMENSIONS], *[m for m in chosen if m in FACTS]]:
        source = getattr(new if name in logs else w, name)
        if name in DIMENSIONS:
            V.publish(source, paths[name])
            continue
        column, parts = FACTS[name]
        if reprocess_dates:
            W.replace_partitions(_on_days(source, parts[0], reprocess_dates), paths[name], parts,
                                 _as_written(parts[0], reprocess_dates))
        elif full_refresh:
            W.replace_table(source, paths[name], parts)
        else:
            W.incremental_append(source, paths[name], column, parts)
    for name in [m for m in chosen if m in REBUILT]:
        fact = f"{root}/fct_meal_log_nutrients"
        over = replace(w, nutrient_fact=spark.read.parquet(fact)) if W.table_exists(spark, fact) else w
        over.__dict__["users_bmi"] = w.users_bmi
        V.publish(getattr(over, name), paths[name])
    if "dim_foods_snapshot" in chosen:
        newest = w if w.latest_food_load else replace(w, latest_food_load=True)  # one row per food
        W.snapshot_check(newest.dim_foods, paths["dim_foods_snapshot"], "fdc_id", NUTRIENTS, run_ts)
    return paths


def build_changed_days(w: Warehouse, logs_root: str, root: str, run_ts: str, select: list[str] | None = None) -> list[str]:
    """Bring the facts of the meal logs up to date with all loads under ``logs_root``, late rows and corrections included.

    Only the days whose sums differ from those that the facts were last built from are read and replaced
    (``operators.late``); returns them. ``w`` gives the other inputs."""
    spark, root = w.spark, root.rstrip("/")
    facts = [m for m in FROM_LOGS if select is None or m in select]
    kept = f"{root}/days_of_{'_'.join(facts)}"
    sums = L.raw_sums(spark, logs_root)
    days = L.changed_days(sums, L.kept_sums(spark, kept))
    if days:
        changed = replace(w, raw_meal_logs=L.read_logs(spark, logs_root, days), items_override=None)
        build_marts(changed, root, run_ts, select=facts, reprocess_dates=days)
        V.publish(sums, kept)
    return days


def read_marts(spark: SparkSession, root: str) -> dict[str, DataFrame]:
    """The persisted marts as DataFrames (partition columns restored)."""
    root = root.rstrip("/")
    found = {n: spark.read.parquet(f"{root}/{n}") for n in FACTS if W.table_exists(spark, f"{root}/{n}")}
    found |= {n: V.read(spark, f"{root}/{n}") for n in DIMENSIONS + REBUILT if V.current(spark, f"{root}/{n}")}
    snapshot = f"{root}/dim_foods_snapshot"
    return {**found, "dim_foods_snapshot": W.read_snapshot(spark, snapshot)} if V.current(spark, snapshot) else found
