"""Query of the quality rules: op4."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tidewell.llm import quality_rules
from tidewell.llm._common import read


def op4_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = quality_rules.judge(read(spark, sf_dir, "documents"))
    measures = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")
    return judged.withColumnRenamed("id", "doc_id").select("doc_id", *measures)


ORACLE = r"""
WITH doc AS (
  SELECT doc_id, source, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w,
    list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS ls
  FROM documents
), win AS (SELECT doc_id, i, w[i:i + 7] AS g FROM doc, range(1, len(w) - 6) r(i) WHERE len(w) >= 8),
again AS (SELECT doc_id, i FROM win QUALIFY count(*) OVER (PARTITION BY doc_id, g) > 1),
rep AS (SELECT doc_id, count(DISTINCT p) AS n FROM (SELECT doc_id, unnest(range(i, i + 8)) AS p FROM again) GROUP BY doc_id),
line AS (
  SELECT doc_id, source, t, pos, trim(x, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS x
  FROM (SELECT doc_id, source, t, unnest(ls) AS x, unnest(range(len(ls))) AS pos FROM doc)
), freq AS (SELECT source, lower(x) AS k FROM line GROUP BY source, lower(x) HAVING count(DISTINCT doc_id) > 20),
gone AS (
  SELECT doc_id, sum(length(x)) AS c FROM line JOIN freq ON line.source = freq.source AND lower(x) = k GROUP BY doc_id
), total AS (SELECT doc_id, sum(length(x)) AS c FROM line GROUP BY doc_id)
SELECT doc.doc_id, len(w)::BIGINT AS n_words, length(array_to_string(w, ''))::BIGINT AS word_chars,
  len(regexp_extract_all(t, '[#*$%&|<>]'))::BIGINT AS n_symbols, (len(ls) - len(list_distinct(ls)))::BIGINT AS n_dup_lines,
  coalesce(rep.n, 0)::BIGINT AS n_repeat_words,
  (len(w) < 20 OR 100 * coalesce(rep.n, 0) > 30 * len(w)) AS base_failed,
  NOT (len(w) < 20 OR 100 * coalesce(rep.n, 0) > 30 * len(w))
    AND NOT (coalesce(total.c, 0) - coalesce(gone.c, 0) < 0.3 * coalesce(total.c, 0)) AS kept
FROM doc LEFT JOIN rep USING (doc_id) LEFT JOIN gone ON gone.doc_id = doc.doc_id LEFT JOIN total ON total.doc_id = doc.doc_id
"""

QUERIES = {"op4_quality_rules": op4_quality_rules}
ORACLES = {"op4_quality_rules": ORACLE}
