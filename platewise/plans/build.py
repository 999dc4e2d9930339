"""The warehouse as one lazily composed plan: raw -> staging -> intermediate -> marts.

``Warehouse`` wires the operators the way the model graph does. Each
property returns a DataFrame (a logical plan); nothing runs until an action
or a write. ``as_of`` defaults to the latest day of the raw feed (a scalar
subquery over one pruned column), never the wall clock.

Model -> inventory ID:
  stg_foods B1, stg_users B2, stg_weights B3, stg_meal_logs B4,
  food_nutrients C1, items C2, scaled C3,
  daily_intake C4 (daily_wide: one row per user-day), users_bmi C5, bmi_history C6, segments C7, windowed C8,
  dim_date M1, dim_users M2, dim_meals M3, dim_nutrients M4, dim_foods M5,
  fct_meal_logs M6, fct_meal_log_nutrients M7, fct_bmi_evolution M8,
  fct_user_segments M9, fct_user_segments_windowed M10,
  daily_totals: the reports' first level (R1-R4, D4-D6), register_views A7,
  materialize: write shared models once (used by plans.jobs, A9), after: the
  same warehouse over newer logs only (A9).
"""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field, replace
from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import grams as G
from ..operators import marts as M
from ..operators import staging as S
from ..operators import transforms as T
from ..operators import writes as W
from ..session import scratch_dir
from ..sources import fixtures, seeds


@dataclass
class Warehouse:
    spark: SparkSession
    raw_foods: DataFrame
    raw_users: DataFrame
    raw_weights: DataFrame
    raw_meal_logs: DataFrame | None = None
    items_override: DataFrame | None = None
    tz: str = "UTC"
    as_of_value: Column | str | None = None
    feed_dates: DataFrame | None = None
    latest_food_load: bool = False
    nutrient_fact: DataFrame | None = None
    newer_than: Column | None = None
    personal_targets: dict[int, float] = field(default_factory=lambda: dict(seeds.PERSONAL_TARGETS))

    # ---------------------------------------------------------------- inputs
    @classmethod
    def from_testdata(cls, spark: SparkSession, sf_dir: str, history: str = "events", **kw) -> "Warehouse":
        """history='events': nested daily logs from events (dense 30 days);
        history='orders': item facts from lineitem ⋈ orders (long history)."""
        src = "events" if history == "events" else "orders"
        ts = "ts" if history == "events" else "o_orderdate"
        base = dict(
            spark=spark,
            feed_dates=fixtures.table(spark, sf_dir, src).select(F.to_date(ts).alias("day")),
            raw_foods=fixtures.raw_foods(spark, sf_dir),
            raw_users=fixtures.raw_users(spark, sf_dir),
            raw_weights=fixtures.raw_weight_logs(spark, sf_dir),
        )
        if history == "events":
            base["raw_meal_logs"] = fixtures.raw_meal_logs(spark, sf_dir)
        elif history == "orders":
            base["items_override"] = fixtures.items_orders(spark, sf_dir)
        else:
            raise ValueError(history)
        base.update(kw)
        return cls(**base)

    # ---------------------------------------------------------------- seeds
    @cached_property
    def meals(self) -> DataFrame:
        return seeds.meals(self.spark)

    @cached_property
    def nutrients(self) -> DataFrame:
        return seeds.nutrients(self.spark)

    @cached_property
    def targets(self) -> DataFrame:
        return seeds.nutrient_daily_targets(self.spark)

    @cached_property
    def bmi_categories(self) -> DataFrame:
        return seeds.bmi_categories(self.spark)

    # -------------------------------------------------------------- staging
    @cached_property
    def _parsed_foods(self) -> DataFrame:
        """B1 with the nutrient list: the document is parsed once for B1 and C1."""
        return S.stg_foods(self.raw_foods, self.tz, with_nutrients=True)

    @cached_property
    def stg_foods(self) -> DataFrame:
        return self._parsed_foods.drop("food_nutrients")

    @cached_property
    def stg_users(self) -> DataFrame:
        return S.stg_users(self.raw_users, self.tz)

    @cached_property
    def stg_weights(self) -> DataFrame:
        return S.stg_weight_logs(self.raw_weights, self.tz)

    @cached_property
    def stg_meal_logs(self) -> DataFrame:
        if self.raw_meal_logs is None:
            raise ValueError("no nested meal logs in this warehouse")
        logs = S.stg_meal_logs(self.raw_meal_logs, self.tz)
        return logs if self.newer_than is None else logs.where(W.above(F.to_date("logged_at"), self.newer_than))

    # --------------------------------------------------------- intermediate
    @cached_property
    def food_nutrients(self) -> DataFrame:
        return T.food_nutrients(self._parsed_foods, latest_only=self.latest_food_load)

    @cached_property
    def items(self) -> DataFrame:
        if self.items_override is not None:
            items = self.items_override
            return items if self.newer_than is None else items.where(W.above(F.col("logged_date"), self.newer_than))
        return T.meal_items(self.stg_meal_logs, self.meals)

    @cached_property
    def scaled_exact(self) -> DataFrame:
        """C3 in exact gram amounts, which everything below adds up."""
        return T.scaled_exact(self.items, self.food_nutrients)

    @cached_property
    def scaled(self) -> DataFrame:
        return G.as_decimals(self.scaled_exact)

    @property
    def as_of(self) -> Column:
        """The run date: explicit, else the latest day of the raw feed (a
        scalar subquery over one pruned column), else the latest item day."""
        if self.as_of_value is not None:
            v = self.as_of_value
            return F.lit(v).cast("date") if isinstance(v, str) else v
        if self.feed_dates is not None:
            return self.feed_dates.select(F.max("day")).scalar()
        return self.items.select(F.max("logged_date")).scalar()

    def feed_span(self) -> tuple[Column, Column]:
        """(first, last) day of the raw feed: one scalar subquery over one pruned column."""
        src = self.feed_dates if self.feed_dates is not None else self.items.select(F.col("logged_date").alias("day"))
        span = src.select(F.struct(F.min("day").alias("lo"), F.max("day").alias("hi"))).scalar()
        return span["lo"], span["hi"]

    @cached_property
    def daily_wide(self) -> DataFrame:
        """C4 before its last step: one row per user-day with the five sums."""
        return T.daily_wide(self.scaled_exact, self.as_of)

    @cached_property
    def daily_exact(self) -> DataFrame:
        return T.daily_long(self.daily_wide)

    @cached_property
    def daily_intake(self) -> DataFrame:
        return G.as_decimals(self.daily_exact)

    @cached_property
    def daily_totals(self) -> DataFrame:
        """All-history daily totals (the reports' first level), from scaled items."""
        return T.daily_totals(self.scaled_exact)

    @cached_property
    def totals_wide(self) -> DataFrame:
        """``daily_totals`` in wide rows, for reports that sum on before they unpivot."""
        return T.totals_wide(self.scaled_exact)

    @cached_property
    def users_bmi(self) -> DataFrame:
        return T.users_with_bmi(self.stg_users, self.stg_weights, self.bmi_categories)

    @cached_property
    def bmi_history(self) -> DataFrame:
        return T.bmi_history(self.stg_weights, self.stg_users)

    @cached_property
    def segments(self) -> DataFrame:
        return T.nutrient_segments(self.daily_wide, self.users_bmi, self.targets, self.personal_targets)

    @cached_property
    def windowed(self) -> DataFrame:
        """C8 over the accumulated nutrient fact where one is given, else over the raw chain.

        The fact on disk holds days that a truncated daily feed no longer
        has, so a daily run still sees 30 days (SURVEY §2.10 item 3)."""
        daily = self.daily_wide if self.nutrient_fact is None else T.to_wide(
            T.since_days(self.nutrient_fact, self.as_of, 30), "value_g")
        return T.segments_windowed(daily, self.users_bmi, self.as_of, self.targets, self.personal_targets)

    # ---------------------------------------------------------------- marts
    @cached_property
    def dim_date(self) -> DataFrame:
        return M.dim_date(self.spark)

    @cached_property
    def dim_users(self) -> DataFrame:
        return M.dim_users(self.users_bmi, self.personal_targets.get(1, 0.8))

    @cached_property
    def dim_meals(self) -> DataFrame:
        return M.dim_meals(self.meals)

    @cached_property
    def dim_nutrients(self) -> DataFrame:
        return M.dim_nutrients(self.nutrients)

    @cached_property
    def dim_foods(self) -> DataFrame:
        return M.dim_foods(self.food_nutrients)

    @cached_property
    def fct_meal_logs(self) -> DataFrame:
        return M.fct_meal_logs(self.items)

    @cached_property
    def meal_nutrients_exact(self) -> DataFrame:
        return M.fct_meal_log_nutrients(self.scaled_exact)

    @cached_property
    def fct_meal_log_nutrients(self) -> DataFrame:
        return G.as_decimals(self.meal_nutrients_exact)

    @cached_property
    def fct_bmi_evolution(self) -> DataFrame:
        return M.fct_bmi_evolution(self.bmi_history)

    @cached_property
    def fct_user_segments(self) -> DataFrame:
        return M.fct_user_segments(self.segments)

    @cached_property
    def fct_user_segments_windowed(self) -> DataFrame:
        return M.fct_user_segments_windowed(self.windowed)

    # ------------------------------------------------------- materialising
    def materialize(self, *names: str) -> "Warehouse":
        """Compute the named models once, as parquet tables in shared storage.

        Models derived later read the table (columns pruned, filters pushed)
        instead of recomputing the chain from raw; call this before touching
        their dependants. The names of one call are written side by side, each
        computed from what was written before it. The folders go when the run
        ends.
        """
        frames = {n: (getattr(self, n), scratch_dir(self.spark, n)) for n in names}
        with ThreadPoolExecutor(max_workers=min(4, len(frames))) as pool:
            list(pool.map(lambda f: f[0].write.parquet(f[1]), frames.values()))
        for n, (df, path) in frames.items():
            self.__dict__[n] = self.spark.read.schema(df.schema).parquet(path)
        return self

    def after(self, day: Column) -> "Warehouse":
        """The same warehouse over meal logs of later days only; as_of stays that of the whole feed."""
        return replace(self, newer_than=day, as_of_value=self.as_of)

    # ---------------------------------------------------------------- views
    MODEL_VIEWS = (
        "stg_foods", "stg_users", "stg_weights", "food_nutrients", "items", "scaled", "daily_intake",
        "users_bmi", "bmi_history", "segments", "windowed", "dim_date", "dim_users", "dim_meals",
        "dim_nutrients", "dim_foods", "fct_meal_logs", "fct_meal_log_nutrients", "fct_bmi_evolution",
        "fct_user_segments", "fct_user_segments_windowed",
    )

    def register_views(self, prefix: str = "") -> list[str]:
        """Expose every model as a temporary view for SQL users (lazy: a
        view is a named logical plan, nothing is computed here)."""
        names = []
        for m in self.MODEL_VIEWS:
            getattr(self, m).createOrReplaceTempView(prefix + m)
            names.append(prefix + m)
        if self.raw_meal_logs is not None:
            self.stg_meal_logs.createOrReplaceTempView(prefix + "stg_meal_logs")
            names.append(prefix + "stg_meal_logs")
        return names

