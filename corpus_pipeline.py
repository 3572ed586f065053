"""The corpus pipeline: stages over ``documents``, each stored as Parquet and read again by the next.

toxicity drops toxic documents, near keeps one document of each group of near duplicates, contamination drops documents
that hold benchmark passages, pii puts kinds in place of personal data, mix repeats documents to the sources' targets.
Every stage returns the columns of ``documents``; where a text changes, ``n_chars`` follows it. Null, empty and repeated
rows and extra columns behave as the operators' docstrings say.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cirrus.llm import op2_near, op4_decontaminate, op6_mix, op9_pii, op10_toxicity
from cirrus.llm.common import stored, table


def _sized(docs: DataFrame) -> DataFrame:
    return docs.withColumn("n_chars", F.char_length("text").cast("long")) if "n_chars" in docs.columns else docs


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    model = op10_toxicity.learn(*op10_toxicity.training(docs, table(spark, sf_dir, "labels")))
    return op10_toxicity.clean(docs, model)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return op2_near.one_of_each(docs)


def contamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    found = op4_decontaminate.decontaminate(docs, table(spark, sf_dir, "benchmark")).where("contaminated").select(
        F.col("doc_id").alias("bad_id"), F.col("_th").alias("bad_th"))
    digest = F.xxhash64(F.coalesce(docs["text"], F.lit("")))
    return docs.join(found, docs["doc_id"].eqNullSafe(found["bad_id"]) & (digest == found["bad_th"]), "left_anti")


def pii(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return _sized(op9_pii.redact(docs, op9_pii.learn(docs)))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return _sized(op6_mix.mix(docs))


STAGES = [("toxicity", toxicity), ("near", near), ("contamination", contamination), ("pii", pii), ("mix", mix)]
#: SQL expresses neither the toxicity nor the personal data stage.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline_{name}")
    return docs
