"""Queries of the two classifiers: op5 and op6."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewell.llm import quality_classifier, toxicity
from tidewell.llm._common import read


def remainder(id_col: Column, n: int) -> Column:
    return F.crc32(id_col.cast("string")) % n


def toxicity_model(spark: SparkSession, docs: DataFrame, sf_dir: str) -> toxicity.Model:
    return toxicity.fit(docs, read(spark, sf_dir, "labels"), lambda i: remainder(i, 5) != 0)


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    scored = toxicity.score(docs, toxicity_model(spark, docs, sf_dir))
    return scored.select(
        "doc_id",
        (remainder(F.col("doc_id"), 5) == 0).alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
        F.transform("evidence", lambda e: e["id"]).alias("evidence_ids"),
    )


def op6_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    model = quality_classifier.fit(docs, read(spark, sf_dir, "labels"), lambda i: remainder(i, 4) != 2)
    return quality_classifier.score(docs, model).select(
        "doc_id",
        (remainder(F.col("doc_id"), 4) == 2).alias("held_out"),
        "score",
        (F.col("score") >= 0.7).cast("int").alias("predicted"),
    )


QUERIES = {"op5_toxicity": op5_toxicity, "op6_quality_classifier": op6_quality_classifier}
ORACLES: dict[str, str] = {}
