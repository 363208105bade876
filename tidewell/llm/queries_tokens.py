"""Queries over token ids: op1 and op7."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewell.llm import byte_bpe, token_counts
from tidewell.llm._common import read, sha256_hex, stored


def vocabulary(name: str = "byte_bpe_multi_50k.tiktoken") -> byte_bpe.Vocabulary:
    import public_tokenizers

    return byte_bpe.Vocabulary.from_file(public_tokenizers.path(name), public_tokenizers.PATTERN)


def digests(docs: DataFrame) -> DataFrame:
    return byte_bpe.encode(docs, vocabulary(), decoded=True).select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        sha256_hex(F.array_join(F.col("ids").cast("array<string>"), ",")).alias("ids_sha256"),
        sha256_hex("decoded").alias("decoded_sha256"),
    )


def op1_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return digests(read(spark, sf_dir, "documents"))


def op7_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    counted = token_counts.lengths(read(spark, sf_dir, "documents"), vocabulary())
    return token_counts.limits(stored(token_counts.histogram(counted)))  # it is read twice


QUERIES = {"op1_byte_bpe": op1_byte_bpe, "op7_token_counts": op7_token_counts}
ORACLES: dict[str, str] = {}
