"""Registered queries of the training-data operators: thin calls with production parameters over whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from platewise.llm import decontaminate as op5
from platewise.llm import lm_scoring as op1
from platewise.llm import minhash as op13
from platewise.llm import packing as op4
from platewise.llm import periodic_runs as op11
from platewise.llm import secret_scan as op9
from platewise.llm import simhash as op7
from platewise.llm import toxicity as op8
from platewise.llm import training_order as op2
from platewise.llm import turn_repair as op12
from platewise.llm import url_filter as op6
from platewise.llm import vptree as op3
from platewise.llm import warc as op10
from platewise.llm.common import pick, table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(name: str):
    def add(fn):
        QUERIES[name] = fn
        return fn
    return add


@query("op1_lm_scoring")
def op1_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op1.score_documents(table(spark, sf_dir, "documents"))


@query("op2_training_order")
def op2_training_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op2.materialised(table(spark, sf_dir, "documents"))


@query("op4_best_fit_packing")
def op4_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op4.digest(op4.pack_documents(table(spark, sf_dir, "documents")))


@query("op5_decontaminate")
def op5_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = pick(table(spark, sf_dir, "documents"), "doc_id", "text")
    return op5.digest(op5.decontaminate(docs, table(spark, sf_dir, "benchmark"), with_spans=False))


@query("op7_simhash")
def op7_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op7.digest(table(spark, sf_dir, "documents"))


@query("op8_toxicity")
def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op8.digest(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query("op9_secret_scan")
def op9_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op9.scan_documents(table(spark, sf_dir, "documents"))


@query("op6_url_filter")
def op6_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op6.judged_pages(table(spark, sf_dir, "pages"))


ORACLE["op6_url_filter"] = op6.oracle_sql()


@query("op10_warc")
def op10_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op10.round_trip(spark, table(spark, sf_dir, "pages"))


@query("op3_vantage_point_trees")
def op3_vantage_point_trees(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op3.nearest(table(spark, sf_dir, "embeddings"))


@query("op11_periodic_runs")
def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op11.document_runs(table(spark, sf_dir, "documents"))


@query("op13_minhash")
def op13_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op13.digest(table(spark, sf_dir, "documents"))


@query("op12_turn_repair")
def op12_turn_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op12.digest(table(spark, sf_dir, "conversations"))


ORACLE["op5_decontaminate"] = op5.oracle_sql()
ORACLE["op10_warc"] = op10.oracle_sql()
