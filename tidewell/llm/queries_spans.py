"""Queries of the two scanners: op3 and op10."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tidewell.llm import pii, secrets
from tidewell.llm import spans as S
from tidewell.llm._common import read, sha256_hex


def op3_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secrets.find(read(spark, sf_dir, "documents"))
    counts = [S.count(k).alias(f"n_{k}") for k in ("assign", "access", "hex")]
    return found.select("doc_id", *counts, sha256_hex(S.joined(True)).alias("base_sha256"), S.joined(False).alias("spans"))


def op10_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.find(read(spark, sf_dir, "documents"))
    counts = [S.count(k).alias(f"n_{k}") for k in pii.KINDS]
    return found.select("doc_id", *counts, sha256_hex(S.joined(True)).alias("base_sha256"), S.joined(False).alias("spans"))


QUERIES = {"op3_secret_scan": op3_secret_scan, "op10_pii": op10_pii}
ORACLES: dict[str, str] = {}
