"""Query of tool-call linking: op9."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewell.llm import chat_tools
from tidewell.llm._common import read


def op9_tool_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    chats = read(spark, sf_dir, "conversations")
    asked, answers = chat_tools.turns_as_calls(chats)
    calls, results = chat_tools.tool_messages(chats)
    linked = chat_tools.link(asked.unionByName(calls), answers.unionByName(results), chat_tools.TURN_SCHEMAS)
    return linked.withColumn("errors", F.array_join("errors", ","))


ORACLE = """
WITH RECURSIVE asked AS (
  SELECT conv_id, 'c' || turn AS call_id, turn, CASE WHEN role = 'system' THEN 'set_context' ELSE 'respond' END AS name, text, coalesce(length(text), 11) AS n
  FROM conversations WHERE role IS NULL OR role <> 'assistant'
), ans AS (SELECT conv_id, 'c' || (turn - 1) AS call_id, turn, text FROM conversations WHERE role = 'assistant'),
edge AS (
  SELECT DISTINCT a.conv_id, a.call_id, p.call_id AS parent, p.turn > a.turn AS ahead
  FROM (SELECT *, unnest(CASE n % 4 WHEN 0 THEN [turn - 2] WHEN 1 THEN []::BIGINT[] WHEN 2 THEN [turn + 2] ELSE [turn - 2, turn + 4] END) AS need FROM asked) a
  JOIN asked p ON p.conv_id = a.conv_id AND p.turn = a.need
), reached AS (
  SELECT conv_id, call_id FROM edge WHERE ahead
  UNION SELECT e.conv_id, e.call_id FROM edge e JOIN reached r ON r.conv_id = e.conv_id AND r.call_id = e.parent
), inner_edge AS (SELECT e.conv_id, e.call_id, e.parent FROM edge e SEMI JOIN reached r ON r.conv_id = e.conv_id AND r.call_id = e.parent),
above AS (
  SELECT conv_id, call_id, parent AS top FROM inner_edge
  UNION SELECT a.conv_id, a.call_id, e.parent FROM above a JOIN inner_edge e ON e.conv_id = a.conv_id AND e.call_id = a.top
), stuck AS (
  SELECT conv_id, call_id FROM above WHERE call_id = top
  UNION SELECT a.conv_id, a.call_id FROM above a JOIN above c ON c.conv_id = a.conv_id AND c.call_id = a.top AND c.top = c.call_id
), chain AS (
  SELECT conv_id, call_id, 1 AS k FROM reached r
  WHERE NOT EXISTS (SELECT 1 FROM stuck s WHERE s.conv_id = r.conv_id AND s.call_id = r.call_id)
  UNION SELECT e.conv_id, e.call_id, c.k + 1 FROM chain c JOIN inner_edge e ON e.conv_id = c.conv_id AND e.parent = c.call_id
  WHERE NOT EXISTS (SELECT 1 FROM stuck s WHERE s.conv_id = e.conv_id AND s.call_id = e.call_id)
), waves AS (
  SELECT r.conv_id, r.call_id, max(c.k) AS wave FROM reached r LEFT JOIN chain c ON c.conv_id = r.conv_id AND c.call_id = r.call_id GROUP BY r.conv_id, r.call_id
), linked AS (
  SELECT a.conv_id, a.call_id, a.turn, a.name, CASE WHEN w.call_id IS NULL THEN 0 ELSE w.wave END AS wave,
    CASE WHEN r.call_id IS NULL THEN 'unanswered' ELSE 'linked' END AS status, r.text AS result,
    CASE WHEN n % 12 = 0 THEN ['arguments'] WHEN n % 12 = 1 OR a.text IS NULL THEN ['missing:prompt'] WHEN n % 12 = 2 THEN ['type:turn']
      WHEN n % 12 = 3 THEN ['unexpected:n'] WHEN n % 12 = 4 THEN ['repeated'] ELSE []::VARCHAR[] END AS errors,
    CASE WHEN n % 12 IN (0, 4) THEN NULL WHEN n % 12 = 1 THEN to_json({'turn': a.turn}) WHEN n % 12 = 2 THEN to_json({'prompt': a.text, 'turn': a.turn::VARCHAR})
      WHEN n % 12 = 3 THEN to_json({'n': n, 'prompt': a.text, 'turn': a.turn}) ELSE to_json({'prompt': a.text, 'turn': a.turn}) END AS arguments
  FROM asked a LEFT JOIN ans r USING (conv_id, call_id) LEFT JOIN waves w ON w.conv_id = a.conv_id AND w.call_id = a.call_id
)
SELECT conv_id, call_id, turn, name, wave::INTEGER AS wave, status, array_to_string(errors, ',') AS errors,
  to_json({'arguments': arguments, 'call_id': call_id, 'errors': errors, 'name': name, 'result': result, 'status': status, 'turn': turn, 'wave': wave})::VARCHAR AS json
FROM linked
UNION ALL
SELECT conv_id, call_id, turn, NULL, NULL, 'orphan', '', to_json({'call_id': call_id, 'result': text, 'status': 'orphan', 'turn': turn})::VARCHAR
FROM ans WHERE NOT EXISTS (SELECT 1 FROM asked a WHERE a.conv_id = ans.conv_id AND a.call_id = ans.call_id)
"""

QUERIES = {"op9_tool_links": op9_tool_links}
ORACLES = {"op9_tool_links": ORACLE}
