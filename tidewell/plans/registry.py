"""All queries of the library and the SQL they are checked against."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewell import read, write
from tidewell.functions import predicates as P
from tidewell.plans import codecs, filters, relational, scans, writes
from tidewell.plans.tables import scratch, views

MODULES = (scans, filters, relational, codecs, writes)


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Query text -> table -> pruned and filtered read -> decimal sum -> top ten."""
    home = scratch(spark)
    views(spark, sf_dir, "lineitem", "orders")
    rows = read(spark).option("query", "SELECT o_custkey, l_returnflag, l_extendedprice FROM lineitem JOIN orders ON l_orderkey = o_orderkey;").load()
    write(rows).options(dbtable="lines", warehouse_dir=home, keep_column_case="on").mode("overwrite").save()
    lines = read(spark).options(dbtable="lines", warehouse_dir=home, keep_column_case="on").where(P.In("l_returnflag", ("A", "R"))).load()
    total = F.sum(F.col("l_extendedprice").cast("decimal(18,2)")).cast("decimal(28,2)").alias("total")
    return lines.groupBy("o_custkey").agg(total, F.count("*").alias("n")).orderBy(F.col("total").desc(), "o_custkey").limit(10)


FLAGSHIP = """SELECT o_custkey, sum(l_extendedprice::DECIMAL(18,2))::DECIMAL(28,2) AS total, count(*) AS n
FROM lineitem JOIN orders ON l_orderkey = o_orderkey WHERE l_returnflag IN ('A', 'R')
GROUP BY o_custkey ORDER BY total DESC, o_custkey LIMIT 10"""


def queries() -> dict:
    return {name: f for m in MODULES for name, f in m.QUERIES.items()} | {"flagship": flagship}


def oracle_sql() -> dict[str, str]:
    return {name: sql for m in MODULES for name, sql in m.ORACLES.items()} | {"flagship": FLAGSHIP}
