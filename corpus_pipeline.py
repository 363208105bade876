"""A training corpus in stages: each works on all rows that the one before has kept.

toxicity drops documents that the classifier scores 0.5 or more; near_dedup keeps one document of
each group; decontamination cuts benchmark passages and drops documents that are mostly such;
pii replaces personal data by its kind; byte_bpe gives the token ids. All stages but the last
return the columns of documents, with n_chars brought up to date where the text changes.

Defined results: null and empty texts pass all stages and have no ids; null ids are kept as they
are; repeated rows fall together in near_dedup; empty tables give empty results; extra columns,
whatever their names, are carried to the last stage, which returns its own columns only.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewell.llm import byte_bpe, decontamination, near_dedup, pii
from tidewell.llm import toxicity as toxicity_operator
from tidewell.llm._common import column_index, read, sha256_hex, stored
from tidewell.llm.queries_classifiers import toxicity_model
from tidewell.llm.queries_tokens import vocabulary


def counted(docs: DataFrame) -> DataFrame:
    """n_chars of the text as it is now, where the table has that column."""
    if "n_chars" not in docs.columns:
        return docs
    at, text = column_index(docs, "n_chars"), column_index(docs, "text")
    flat = docs.toDF(*[f"_c{i}" for i in range(len(docs.columns))])
    return flat.withColumn(f"_c{at}", F.length(f"_c{text}").cast("long")).toDF(*docs.columns)


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return toxicity_operator.drop_toxic(docs, toxicity_model(spark, docs, sf_dir))


def near_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return near_dedup.drop_duplicates(docs, size=5, percent=80)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return counted(decontamination.clean(docs, read(spark, sf_dir, "benchmark")))


def mask_pii(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return counted(pii.mask(docs))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return byte_bpe.encode(docs, vocabulary(), decoded=True).select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        "ids",
        sha256_hex("decoded").alias("decoded_sha256"),
    )


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", toxicity),
    ("near_dedup", near_dedup_stage),
    ("decontamination", decontaminate),
    ("pii", mask_pii),
    ("byte_bpe", encode),
]

#: No SQL can express the first, second, fourth and fifth stage.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    for _, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir))
    return docs
