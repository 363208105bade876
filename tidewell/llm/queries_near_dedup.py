"""Query of near-duplicates: op8."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tidewell.llm import near_dedup
from tidewell.llm._common import read


def op8_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.near_duplicates(read(spark, sf_dir, "documents"), size=4, percent=80)


QUERIES = {"op8_near_dedup": op8_near_dedup}
ORACLES: dict[str, str] = {}
