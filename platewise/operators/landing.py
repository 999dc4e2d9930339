"""A1: landing of API pages with a quarantine: every page and document ends up in one of two tables.

A page is a JSON array of food documents. What cannot be landed goes to the quarantine with its file, its place in the
page (NULL for a page that is no array, which is kept whole), the text and the reason, so it can be landed again once
mended. Landed and quarantined rows add up to the documents and broken pages read.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import remove_path, scratch_dir
from .writes import append_table

REASONS = {
    "page": "the page is not a JSON array",
    "object": "the document is not a JSON object",
    "fdcId": "fdcId is missing or not a whole number",
    "publicationDate": "publicationDate is not a date",
    "foodNutrients": "foodNutrients is not a list",
}


def checked_documents(pages: DataFrame, payload: str = "payload", file: str = "file") -> DataFrame:
    """``file``, ``position`` (from 0), ``fdc_id``, ``text`` as received and ``reason`` (NULL: can be landed), one row per
    document, and one per page that is no array. An empty array has none; a NULL or blank page is no array."""
    text = F.btrim(F.col(payload), F.lit(" \t\n\r"))
    docs = F.when(text.startswith("[") & text.endswith("]"), F.from_json(text, "array<string>"))
    rows = pages.select(F.col(file).alias("file"), F.col(payload).alias("_page"), docs.alias("_docs")).select(
        "file", F.col("_docs").isNull().alias("_broken"),
        F.posexplode(F.when(F.col("_docs").isNull(), F.array("_page")).otherwise(F.col("_docs"))).alias("position", "text"))
    field = lambda name: F.get_json_object("text", f"$.{name}")
    as_date = F.try_to_date(field("publicationDate"), "yyyy-MM-dd")
    list_ = field("foodNutrients")
    reason = F.when(F.col("_broken"), "page").when(~F.coalesce(F.trim("text").startswith("{"), F.lit(False)), "object") \
        .when(field("fdcId").try_cast("long").isNull() | ~field("fdcId").rlike(r"^[0-9]+$"), "fdcId") \
        .when(field("publicationDate").isNotNull() & as_date.isNull(), "publicationDate") \
        .when(list_.isNotNull() & ~F.trim(list_).startswith("["), "foodNutrients")
    checked = rows.select("*", reason.alias("reason"))
    return checked.select("file", F.when(~F.col("_broken"), F.col("position")).alias("position"),
                          F.when(F.col("reason").isNull(), field("fdcId").cast("long")).alias("fdc_id"), "text", "reason")


def landed(checked: DataFrame, loaded_at: Column | str | None = None) -> DataFrame:
    """raw_foods rows of the documents without a fault."""
    ts = F.current_timestamp() if loaded_at is None else F.to_timestamp(F.lit(loaded_at)) if isinstance(loaded_at, str) else loaded_at
    return checked.where("reason IS NULL").select("fdc_id", ts.alias("loaded_at"), F.col("text").alias("raw_json"))


def quarantined(checked: DataFrame, loaded_at: Column | str | None = None) -> DataFrame:
    """``file``, ``position``, ``text``, ``reason`` (in words) and ``loaded_at`` of the rest."""
    ts = F.current_timestamp() if loaded_at is None else F.to_timestamp(F.lit(loaded_at)) if isinstance(loaded_at, str) else loaded_at
    words = F.create_map(*[F.lit(x) for kv in REASONS.items() for x in kv])
    return checked.where("reason IS NOT NULL").select("file", "position", "text", words[F.col("reason")].alias("reason"), ts.alias("loaded_at"))


@dataclass(frozen=True)
class Landing:
    """What a load has read and where it went."""
    documents: int
    broken_pages: int
    landed: int
    quarantined: int


def load_food_pages(pages: DataFrame, raw_path: str, quarantine_path: str, loaded_at: Column | str | None = None,
                    payload: str = "payload", file: str = "file") -> Landing:
    """A1: append pages to the raw food table and the quarantine. The pages are read and checked once."""
    spark, stage = pages.sparkSession, scratch_dir(pages.sparkSession, "landing")
    checked_documents(pages, payload, file).write.parquet(stage)
    checked = spark.read.parquet(stage)
    append_table(landed(checked, loaded_at), raw_path)
    append_table(quarantined(checked, loaded_at), quarantine_path)
    n = checked.agg(F.count_if(~F.col("reason").eqNullSafe("page")), F.count_if(F.col("reason") == "page"),
                    F.count_if(F.col("reason").isNull()), F.count_if(F.col("reason").isNotNull())).first()
    out = Landing(*n)
    remove_path(spark, stage)
    if out.landed + out.quarantined != out.documents + out.broken_pages:
        raise RuntimeError(f"documents lost while landing: {out}")
    return out
