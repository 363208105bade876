"""Predicates that reach the scan, and those that Spark evaluates above it."""

from __future__ import annotations

import datetime as dt
from decimal import Decimal

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewell.functions import predicates as P
from tidewell.plans.scans import known
from tidewell.plans.tables import table


def of(name: str, columns: str, *predicates):
    """A query that selects columns of a table where all predicates hold."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return known(spark, sf_dir, name).where(*predicates).load().select(*columns.split(", "))

    return run


def status(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders with a status that is null for F: the input tables have no nulls."""
    return table(spark, sf_dir, "orders").select("o_orderkey", F.expr("nullif(o_orderstatus, 'F')").alias("s"))


def filter_null(spark: SparkSession, sf_dir: str) -> DataFrame:
    return status(spark, sf_dir).where(P.column(P.Null("s"))).select("o_orderkey")


def filter_not_null(spark: SparkSession, sf_dir: str) -> DataFrame:
    return status(spark, sf_dir).where(P.column(P.Null("s", False))).select("o_orderkey", "s")


def filter_null_safe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return status(spark, sf_dir).where(P.column(P.Not(P.Compare("s", "<=>", "O")))).select("o_orderkey")


def filter_three_valued(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = P.Not(P.Either(P.Compare("s", "=", "O"), P.Compare("o_orderkey", "<", 100)))
    return status(spark, sf_dir).where(P.column(p)).select("o_orderkey")


def filter_col_to_col(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").where(F.col("l_discount") > F.col("l_tax")).select("l_orderkey", "l_linenumber")


def filter_expression(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").where((F.col("l_orderkey") % 7 + F.length("l_returnflag")) > 4).select("l_orderkey", "l_linenumber")


C = P.Compare
QUERIES = {
    "filter_eq": of("orders", "o_orderkey", C("o_orderstatus", "=", "F")),
    "filter_range": of("lineitem", "l_orderkey, l_linenumber", C("l_quantity", ">=", 10), C("l_quantity", "<", 20)),
    "filter_in": of("orders", "o_orderkey", P.In("o_orderpriority", ("1-URGENT", "2-HIGH"))),
    "filter_numeric": of("lineitem", "l_orderkey, l_linenumber", C("l_discount", ">", 0.05), C("l_linenumber", "<=", 3)),
    "filter_decimal": of("orders", "o_orderkey", C("o_totalprice", ">", Decimal("100000.50"))),
    "filter_conjunction": of("orders", "o_orderkey", C("o_orderstatus", "=", "F"), C("o_custkey", "<", 500)),
    "filter_or": of("orders", "o_orderkey", P.Either(C("o_orderstatus", "=", "F"), C("o_custkey", "=", 7))),
    "filter_nested": of("orders", "o_orderkey", P.Either(C("o_orderstatus", "=", "P"), P.Both(C("o_custkey", "<", 100), P.Not(C("o_orderstatus", "=", "F"))))),
    "filter_not": of("orders", "o_orderkey", P.Either(P.Not(C("o_custkey", "=", 3)), P.Null("o_custkey"))),
    "filter_startswith": of("documents", "doc_id", P.Text("text", "starts", "The")),
    "filter_endswith": of("documents", "doc_id", P.Text("text", "ends", ".")),
    "filter_contains": of("documents", "doc_id", P.Text("text", "contains", "and the")),
    "filter_quote_literal": of("documents", "doc_id", P.Not(P.Text("text", "contains", "it's a \\ back 'slash'"))),
    "filter_date": of("orders", "o_orderkey", C("o_orderdate", ">=", dt.datetime(1996, 1, 1)), C("o_orderdate", "<", dt.datetime(1997, 1, 1))),
    "filter_timestamp": of("events", "event_id", C("ts", ">=", dt.datetime(2024, 1, 2, 3, 4, 5, 678901))),
    "like_general": of("documents", "doc_id", P.Like("text", "%the%and%")),
    "like_not": of("documents", "doc_id", P.Not(P.Like("text", "%the%and%"))),
    "like_percent": of("documents", "doc_id", P.Like("text", "%^%%", "^")),
    "like_escape": of("part", "p_partkey", P.Like("p_name", "%e^_%", "^")),
} | {f.__name__: f for f in (filter_null, filter_not_null, filter_null_safe, filter_three_valued, filter_col_to_col, filter_expression)}
ORACLES = {
    "filter_eq": "SELECT o_orderkey FROM orders WHERE o_orderstatus = 'F'",
    "filter_range": "SELECT l_orderkey, l_linenumber FROM lineitem WHERE l_quantity >= 10 AND l_quantity < 20",
    "filter_in": "SELECT o_orderkey FROM orders WHERE o_orderpriority IN ('1-URGENT', '2-HIGH')",
    "filter_numeric": "SELECT l_orderkey, l_linenumber FROM lineitem WHERE l_discount > 0.05::DOUBLE AND l_linenumber <= 3",
    "filter_decimal": "SELECT o_orderkey FROM orders WHERE o_totalprice > 100000.50",
    "filter_conjunction": "SELECT o_orderkey FROM orders WHERE o_orderstatus = 'F' AND o_custkey < 500",
    "filter_or": "SELECT o_orderkey FROM orders WHERE o_orderstatus = 'F' OR o_custkey = 7",
    "filter_nested": "SELECT o_orderkey FROM orders WHERE o_orderstatus = 'P' OR (o_custkey < 100 AND NOT o_orderstatus = 'F')",
    "filter_not": "SELECT o_orderkey FROM orders WHERE NOT o_custkey = 3 OR o_custkey IS NULL",
    "filter_startswith": "SELECT doc_id FROM documents WHERE starts_with(text, 'The')",
    "filter_endswith": "SELECT doc_id FROM documents WHERE ends_with(text, '.')",
    "filter_contains": "SELECT doc_id FROM documents WHERE contains(text, 'and the')",
    "filter_quote_literal": "SELECT doc_id FROM documents WHERE NOT contains(text, 'it''s a \\ back ''slash''')",
    "filter_date": "SELECT o_orderkey FROM orders WHERE o_orderdate >= DATE '1996-01-01' AND o_orderdate < DATE '1997-01-01'",
    "filter_timestamp": "SELECT event_id FROM events WHERE ts >= TIMESTAMP '2024-01-02 03:04:05.678901'",
    "like_general": "SELECT doc_id FROM documents WHERE text LIKE '%the%and%'",
    "like_not": "SELECT doc_id FROM documents WHERE text NOT LIKE '%the%and%'",
    "like_percent": "SELECT doc_id FROM documents WHERE text LIKE '%^%%' ESCAPE '^'",
    "like_escape": "SELECT p_partkey FROM part WHERE p_name LIKE '%e^_%' ESCAPE '^'",
    "filter_null": "SELECT o_orderkey FROM orders WHERE nullif(o_orderstatus, 'F') IS NULL",
    "filter_not_null": "SELECT o_orderkey, nullif(o_orderstatus, 'F') AS s FROM orders WHERE nullif(o_orderstatus, 'F') IS NOT NULL",
    "filter_null_safe": "SELECT o_orderkey FROM orders WHERE nullif(o_orderstatus, 'F') IS DISTINCT FROM 'O'",
    "filter_three_valued": "SELECT o_orderkey FROM orders WHERE NOT (nullif(o_orderstatus, 'F') = 'O' OR o_orderkey < 100)",
    "filter_col_to_col": "SELECT l_orderkey, l_linenumber FROM lineitem WHERE l_discount > l_tax",
    "filter_expression": "SELECT l_orderkey, l_linenumber FROM lineitem WHERE l_orderkey % 7 + length(l_returnflag) > 4",
}
