"""Derive the warehouse's raw input shapes from the driver's parquet tables.

Every frame here is computed by Spark from the given tables, so its size
grows with them. The derivation rules are deterministic functions of the
keys (see FIXTURES.md §C); nothing is sampled or capped.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schemas
from ..functions import date_id

DEFAULT_LOADED_AT = "2024-02-01 00:00:00"
REFETCH_LOADED_AT = "2024-03-01 00:00:00"


# Declared schemas of the driver's tables (FIXTURES.md §D): reading with a
# schema skips the footer-inference job, which at scale touches every file.
TESTDATA_SCHEMAS = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
              "o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, "
                "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, "
                "l_linestatus string, l_shipdate timestamp_ntz",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    reader = spark.read
    if name in TESTDATA_SCHEMAS:
        reader = reader.schema(TESTDATA_SCHEMAS[name])
    return reader.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


# --------------------------------------------------------------------- users
def raw_users(spark: SparkSession, sf_dir: str) -> DataFrame:
    """customer ⋈ nation -> users seed shape (user_name is PII, kept raw)."""
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_nationkey")
    n = table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    key = F.col("c_custkey")
    return (c.join(n, c.c_nationkey == n.n_nationkey, "inner")
            .select(
                key.cast("long").alias("user_id"),
                F.col("c_name").alias("user_name"),
                F.col("n_name").alias("country"),
                F.date_add(F.lit("1950-01-01").cast("date"), ((key * 11) % 18250).cast("int")).alias("birth_date"),
                (F.lit(150) + key % 50).cast("double").alias("height_cm"),
                F.timestamp_seconds(F.lit(1672531200) + (key * 7919) % 31536000).alias("registered_at"),
            ))


def raw_weight_logs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """signup events -> weight logs (naive UTC timestamps)."""
    e = table(spark, sf_dir, "events").where(F.col("event_type") == "signup")
    return e.select(
        F.col("user_id").cast("long").alias("user_id"),
        ((F.lit(450) + (F.col("event_id") * 7) % 750) / F.lit(10)).cast("double").alias("weight_kg"),
        F.col("ts").alias("recorded_at"),
    )


# --------------------------------------------------------------------- foods
def _dec1(expr: Column) -> Column:
    """(k % m) * 0.1 as an exact one-decimal amount."""
    return (expr.cast("decimal(9,0)") * F.lit(Decimal("0.1"))).cast("decimal(9,1)")


def food_values(part: DataFrame) -> DataFrame:
    """Wide per-100 g values of each part (before JSON encoding)."""
    k = F.col("p_partkey")
    return part.select(
        k.cast("long").alias("fdc_id"),
        F.col("p_name"),
        _dec1((k * 13) % 1000).alias("protein"),
        _dec1((k * 17) % 1000).alias("fat"),
        _dec1((k * 19) % 1000).alias("carbohydrate"),
        _dec1((k * 23) % 300).alias("fiber"),
        _dec1((k * 29) % 1000).alias("sugar"),
    )


def raw_foods(spark: SparkSession, sf_dir: str, loaded_at: str = DEFAULT_LOADED_AT,
              refetch: bool = False) -> DataFrame:
    """part -> raw_foods rows (fdc_id, loaded_at, raw_json) as the API returns them.

    Edge rows by rule: fiber element absent when key % 5 = 0; sugar amount
    "n/a" when key % 7 = 0; a duplicate, smaller protein element when
    key % 13 = 0; an irrelevant nutrient 301 always; description missing when
    key % 89 = 0; empty nutrient list when key % 97 = 0; five decimals of
    protein when key % 101 = 0; a fat amount of "2.5e8" when key % 173 = 0; a
    second document of the same food and load with one more gram of protein
    and nothing else when key % 107 = 0 (first load only).

    ``refetch=True`` models a later monthly load: only parts with
    p_size > 40 are fetched again, their protein value changed, and foods
    that had no nutrients before now have them.
    """
    part = table(spark, sf_dir, "part")
    if refetch:
        part = part.where(F.col("p_size") > 40)
    v = food_values(part)
    k = F.col("fdc_id")
    if refetch:
        v = v.withColumn("protein", _dec1((k * 13 + 7) % 1000))

    def elem(number: str, amount: Column) -> Column:
        return F.struct(F.lit(number).alias("number"), amount.cast("string").alias("amount"))

    protein = F.col("protein").cast("decimal(12,5)") + F.when(k % 101 == 0, F.lit(Decimal("0.00004"))).otherwise(
        F.lit(Decimal("0.00000")))
    elems = F.array(
        elem("203", protein),
        elem("204", F.when(k % 173 == 0, F.lit("2.5e8")).otherwise(F.col("fat").cast("string"))),
        elem("205", F.col("carbohydrate")),
        F.when(k % 5 != 0, elem("291", F.col("fiber"))),
        elem("269", F.when(k % 7 == 0, F.lit("n/a")).otherwise(F.col("sugar").cast("string"))),
        elem("301", F.lit("1.5")),
        F.when(k % 13 == 0, elem("203", (F.col("protein") / 2).cast("decimal(9,2)"))),
    )
    again = F.array(elem("203", protein + F.lit(Decimal("1"))))
    present = F.filter(elems, lambda x: x.isNotNull())
    nutrients = present if refetch else F.when(
        k % 97 == 0, F.array().cast(schemas.FOOD_NUTRIENTS_JSON)).otherwise(present)
    lists = F.array(nutrients) if refetch else F.when(
        (k % 107 == 0) & (k % 97 != 0), F.array(nutrients, again)).otherwise(F.array(nutrients))
    v = v.select("*", F.explode(lists).alias("_nutrients"))
    doc = F.struct(
        k.alias("fdcId"),
        F.when(k % 89 != 0, F.concat(F.col("p_name"), F.lit(" #"), k.cast("string"))).alias("description"),
        F.date_format(F.date_add(F.lit("2019-04-01").cast("date"), (k % 1000).cast("int")), "yyyy-MM-dd")
        .alias("publicationDate"),
        F.col("_nutrients").alias("foodNutrients"),
    )
    return v.select(
        k.alias("fdc_id"),
        F.to_timestamp(F.lit(loaded_at + "+00:00")).alias("loaded_at"),  # an instant, whatever the session zone
        F.to_json(doc).alias("raw_json"),
    )


def food_pages(spark: SparkSession, sf_dir: str, page_size: int = 200) -> DataFrame:
    """Group food documents into API-style pages: one JSON array text per page
    (at most ``page_size`` consecutive ids per page, so every group is bounded)."""
    docs = raw_foods(spark, sf_dir).select("fdc_id", "raw_json")
    return (docs.groupBy(F.floor(F.col("fdc_id") / page_size).alias("page_no"))
            .agg(F.concat(F.lit("["), F.array_join(F.collect_list("raw_json"), ","), F.lit("]"))
                 .alias("payload")))


# ---------------------------------------------------------------- meal items
def faulty_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``food_pages`` with faults: pages with number % 5 = 3 are cut short; documents have a wrong fdcId (key % 151 = 0), date
    (% 163 = 0) or nutrient list (% 167 = 0), or are text instead of an object (% 173 = 0); the first rule counts."""
    docs = raw_foods(spark, sf_dir).select("fdc_id", "raw_json")
    k, j = F.col("fdc_id"), F.col("raw_json")
    doc = (F.when(k % 151 == 0, F.regexp_replace(j, '"fdcId":', '"fdcId":"x",  "was":'))
           .when(k % 163 == 0, F.regexp_replace(j, '"publicationDate":"[0-9]{4}', '"publicationDate":"20x4'))
           .when(k % 167 == 0, F.regexp_replace(j, '"foodNutrients":', '"foodNutrients":"none","were":'))
           .when(k % 173 == 0, F.lit('"no document"')).otherwise(j))
    page = (docs.select(F.floor(k / 200).alias("page_no"), doc.alias("raw_json")).groupBy("page_no")
            .agg(F.concat(F.lit("["), F.array_join(F.collect_list("raw_json"), ","), F.lit("]")).alias("payload")))
    cut = F.when(F.col("page_no") % 5 == 3, F.expr("left(payload, length(payload) - 9)")).otherwise(F.col("payload"))
    return page.select(F.concat(F.lit("page-"), F.col("page_no").cast("string")).alias("file"), cut.alias("payload"))


LOG_BLOCK = 100_000
EVENT_MEALS = {"view": 1, "click": 2, "purchase": 3}


def _event_meal_id() -> Column:
    t = F.col("event_type")
    return (F.when(t == "view", 1).when(t == "click", 2).when(t == "purchase", 3)).cast("int")


def _event_food(spark: SparkSession, sf_dir: str) -> Column:
    """The food of an event: any key up to the largest part key (0 is an unknown food)."""
    foods = table(spark, sf_dir, "part").select(F.max("p_partkey")).scalar()
    return ((F.col("event_id") * 31) % foods).cast("long")


def items_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dense 30-day history: view/click/purchase events -> meal items."""
    e = table(spark, sf_dir, "events").where(F.col("event_type").isin(*EVENT_MEALS))
    d = F.to_date(F.col("ts"))
    return e.select(
        F.col("user_id").cast("long").alias("user_id"),
        _event_meal_id().alias("meal_id"),
        _event_food(spark, sf_dir).alias("fdc_id"),
        (F.lit(80) + F.get_json_object("props", "$.k").cast("double")).alias("grams"),
        d.alias("logged_date"),
        date_id(d).alias("logged_date_id"),
    )


def items_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Long history: lineitem ⋈ orders -> meal items (one per line)."""
    li = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_linenumber", "l_quantity")
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    d = F.to_date(F.col("o_orderdate"))
    return (li.join(o, li.l_orderkey == o.o_orderkey, "inner")
            .select(
                F.col("o_custkey").cast("long").alias("user_id"),
                (F.col("l_linenumber") % 3 + 1).cast("int").alias("meal_id"),
                F.col("l_partkey").cast("long").alias("fdc_id"),
                (F.lit(80.0) + F.lit(3.0) * F.col("l_quantity")).cast("double").alias("grams"),
                d.alias("logged_date"),
                date_id(d).alias("logged_date_id"),
            ))


def weight_bands(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One weight band per part: from 45 to 125 kg, up to 49 g wide (some empty); 5 kg where the key % 500 = 0, open above
    122 kg where % 700 = 1."""
    k = F.col("p_partkey")
    low = F.lit(45.0) + ((k * 7919) % 80000) / F.lit(1000.0)
    return table(spark, sf_dir, "part").select(
        k.alias("band_id"), F.when(k % 700 == 1, F.lit(122.0)).otherwise(low).alias("low_kg"),
        F.when(k % 700 != 1, low + F.when(k % 500 == 0, F.lit(5.0)).otherwise((k % 50) / F.lit(1000.0))).alias("high_kg"))


def items_odd_servings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``items_orders`` with servings that take more than plain numbers: eight more decimals where the order key % 7 = 0,
    over 2 * 10^9 g where % 11 = 0, a thousandth of a millionth of a gram where % 13 = 0 (the first rule that fits)."""
    k = F.col("l_orderkey")
    li = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_linenumber", F.col("l_quantity").alias("q"))
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    d = F.to_date(F.col("o_orderdate"))
    return li.join(o, li.l_orderkey == o.o_orderkey, "inner").select(
        F.col("o_custkey").cast("long").alias("user_id"), (F.col("l_linenumber") % 3 + 1).cast("int").alias("meal_id"),
        F.col("l_partkey").cast("long").alias("fdc_id"),
        F.when(k % 7 == 0, F.col("q") + F.lit(0.12345678)).when(k % 11 == 0, F.lit(2e9) + F.col("q") + F.lit(0.5))
        .when(k % 13 == 0, F.lit(1e-9)).otherwise(F.lit(80.0) + F.lit(3.0) * F.col("q")).alias("grams"),
        d.alias("logged_date"), date_id(d).alias("logged_date_id"))


def raw_meal_logs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nested meal logs, one record per user and day, from *all* events.

    breakfast/lunch/dinner come from view/click/purchase events, several items
    a list; every fifth other event leaves an item without food and grams in
    the dinner (dropped by C2), and records with only other events have no meal
    (caught by Q6). Empty breakfast lists are stored as NULL, empty lunch and
    dinner lists as [] (both occur in the raw feed). A record is logged at its
    first event. A day of one user is split by blocks of ``LOG_BLOCK`` event
    ids, so that no record grows with the feed, however busy a user is.
    """
    e = table(spark, sf_dir, "events")
    item = F.struct(
        _event_food(spark, sf_dir).alias("fdc_id"),
        (F.lit(80) + F.get_json_object("props", "$.k").cast("double")).alias("grams"),
    )
    meal = _event_meal_id()
    blank = F.struct(F.lit(None).cast("long").alias("fdc_id"), F.lit(None).cast("double").alias("grams"))

    g = (e.groupBy(F.col("user_id").cast("long").alias("user_id"), F.to_date("ts").alias("day"),
                   F.floor(F.col("event_id") / LOG_BLOCK).alias("block"))
         .agg(F.min("ts").alias("logged_at"), F.collect_list(F.when(meal == 1, item)).alias("b"),
              F.collect_list(F.when(meal == 2, item)).alias("l"),
              F.collect_list(F.when(meal == 3, item).when(meal.isNull() & (F.col("event_id") % 5 == 0), blank)).alias("d")))
    return g.select(
        "user_id",
        F.when(F.size("b") > 0, F.col("b")).cast(schemas.MEAL_ITEMS).alias("breakfast"),
        F.col("l").cast(schemas.MEAL_ITEMS).alias("lunch"),
        F.col("d").cast(schemas.MEAL_ITEMS).alias("dinner"),
        F.col("logged_at").cast("timestamp_ntz").alias("logged_at"),
    )
