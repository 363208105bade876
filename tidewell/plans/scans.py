"""Scans: tables, sub-queries, query text, the reader's schema."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewell import read, write
from tidewell.plans.tables import scratch, table, views


def stored(spark: SparkSession, sf_dir: str, name: str, **options):
    """A reader of an input table that has first been written as a table of the store."""
    home = scratch(spark)
    write(table(spark, sf_dir, name)).options(dbtable=name, warehouse_dir=home, keep_column_case="on", **options).mode("overwrite").save()
    return read(spark).options(dbtable=name, warehouse_dir=home, keep_column_case="on")


def known(spark: SparkSession, sf_dir: str, name: str):
    """A reader of an input table by its name in the catalog."""
    views(spark, sf_dir, name)
    return read(spark).option("dbtable", name)


def scan_partitioned(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All lines, a partition a megabyte, with the files' rows checked against the manifest."""
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    df = stored(spark, sf_dir, "lineitem").options(partition_size_in_mb=1, verify_rows="on").load()
    try:
        df.count()  # planned with these partitions
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    return df


def scan_full(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stored(spark, sf_dir, "nation").load()


def scan_pruned(spark: SparkSession, sf_dir: str) -> DataFrame:
    return known(spark, sf_dir, "lineitem").load().select("l_orderkey", "l_linenumber")


def scan_subquery(spark: SparkSession, sf_dir: str) -> DataFrame:
    views(spark, sf_dir, "orders")
    return read(spark).option("dbtable", "(select o_orderkey, o_custkey from orders where o_orderstatus = 'F')").load()


def scan_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    views(spark, sf_dir, "documents")
    return read(spark).option("query", "select doc_id, lang from documents where contains(text, '|');").load()


def scan_user_schema(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = stored(spark, sf_dir, "events").schema("event_id bigint, props struct<k:int>").load()
    return df.select("event_id", F.col("props.k").alias("k"))


def scan_staged(spark: SparkSession, sf_dir: str) -> DataFrame:
    home = scratch(spark)
    return stored(spark, sf_dir, "customer").options(use_copy_unload="on", stage_dir=f"{home}-stage").load()


def scan_decimal_as_long(spark: SparkSession, sf_dir: str) -> DataFrame:
    views(spark, sf_dir, "orders")
    return read(spark).options(query="select cast(o_orderkey as decimal(38,0)) as k, o_orderstatus from orders", treat_decimal_as_long="true").load()


def count_star(spark: SparkSession, sf_dir: str) -> DataFrame:
    return known(spark, sf_dir, "lineitem").load().agg(F.count("*").alias("n"))


def generator(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.range(1000)


QUERIES = {f.__name__: f for f in (scan_full, scan_pruned, scan_subquery, scan_query, scan_user_schema, scan_staged, scan_decimal_as_long, scan_partitioned, count_star, generator)}
ORACLES = {
    "scan_full": "SELECT * FROM nation",
    "scan_pruned": "SELECT l_orderkey, l_linenumber FROM lineitem",
    "scan_subquery": "SELECT o_orderkey, o_custkey FROM orders WHERE o_orderstatus = 'F'",
    "scan_query": "SELECT doc_id, lang FROM documents WHERE contains(text, '|')",
    "scan_user_schema": "SELECT event_id, json_extract(props, '$.k')::INT AS k FROM events",
    "scan_partitioned": "SELECT * FROM lineitem",
    "scan_staged": "SELECT * FROM customer",
    "scan_decimal_as_long": "SELECT o_orderkey::BIGINT AS k, o_orderstatus FROM orders",
    "count_star": "SELECT count(*) AS n FROM lineitem",
    "generator": "SELECT range AS id FROM range(1000)",
}
