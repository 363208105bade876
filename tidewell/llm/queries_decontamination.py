"""Query of benchmark decontamination: op2."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewell.llm import decontamination as D
from tidewell.llm._common import read, sha256_hex


def op2_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = D.scan(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("item_ids").cast("long").alias("n_items"),
        sha256_hex(D.item_list("item_ids")).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )


ORACLE = r"""
WITH doc AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM documents
), item AS (
  SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM benchmark
), win AS (
  SELECT DISTINCT item_id, least(len(w), 10) AS k, array_to_string(w[i:i + least(len(w), 10) - 1], ' ') AS g
  FROM item, range(1, greatest(len(w) - 9, 1) + 1) r(i) WHERE len(w) > 0
), sizes AS (SELECT DISTINCT k FROM win),
gram AS (
  SELECT doc_id, i, k, array_to_string(w[i:i + k - 1], ' ') AS g
  FROM doc, sizes, range(1, len(w) - k + 2) r(i) WHERE len(w) >= k
), hit AS (SELECT doc_id, i, k, item_id FROM gram JOIN win USING (k, g)),
pos AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + k)) AS p FROM hit) GROUP BY doc_id),
its AS (
  SELECT doc_id, count(*) AS n_items, sha256(string_agg(s, ',' ORDER BY s)) AS h
  FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS s FROM hit) GROUP BY doc_id
)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
  coalesce(h, sha256('')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM doc LEFT JOIN pos USING (doc_id) LEFT JOIN its USING (doc_id)
"""

QUERIES = {"op2_decontamination": op2_decontamination}
ORACLES = {"op2_decontamination": ORACLE}
