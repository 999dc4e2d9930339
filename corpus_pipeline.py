"""The corpus pipeline: documents through five operators of platewise.llm, stage by stage.

toxicity          documents scored at or over the threshold go
simhash           one document of each near-duplicate group stays, that of the smallest doc_id
decontaminate     documents with a benchmark window go
secrets           secrets in the text are masked; n_chars follows the new text; no document goes
pack              documents to token sequences: doc_id, piece, start, length, ids_crc32, sequence_id, offset, ...

Each stage reads all that its predecessor kept, as written Parquet. All but the last return the columns of their
input. Nulls, empty texts, repeated rows and empty tables have the results that the operators' docstrings state.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from platewise.llm import decontaminate, packing, secret_scan, simhash, toxicity
from platewise.llm.common import run_dir, table


def keep_ordinary(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    model = toxicity.train(docs, table(spark, sf_dir, "labels"))
    return toxicity.score(docs, model).where(F.col("toxicity") < toxicity.THRESHOLD).select(*docs.columns)


def keep_distinct(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return simhash.deduplicate(docs)


def keep_uncontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    found = decontaminate.decontaminate(docs, table(spark, sf_dir, "benchmark"), with_spans=False)
    return found.where("n_hit = 0").select(*docs.columns)


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return secret_scan.redact(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.digest(packing.pack_documents(docs))


STAGES = [("toxicity", keep_ordinary), ("simhash", keep_distinct), ("decontaminate", keep_uncontaminated),
          ("secrets", mask_secrets), ("pack", pack)]

#: SQL cannot express the learnt model, the fingerprints or the tokenizer: tests compare with brute force instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the table documents; each one's result is written and read back."""
    docs, root = table(spark, sf_dir, "documents"), run_dir(spark, "pipeline")
    for k, (name, stage) in enumerate(STAGES):
        path = f"{root}/{k}-{name}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
