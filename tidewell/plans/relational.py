"""Relational work above the scans: joins, aggregates, windows, sets, functions."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from tidewell import read
from tidewell.plans.tables import table, views

MONEY = "decimal(18,2)"


def money(c: str):
    return F.col(c).cast(MONEY)


def joined(how: str, *columns: str):
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        """All orders; those of customer 1 and the customer find no partner, as the key is null there."""
        orders = table(spark, sf_dir, "orders").withColumn("k", F.expr("nullif(o_custkey, 1)"))
        return table(spark, sf_dir, "customer").join(orders, F.col("c_custkey") == F.col("k"), how).select(*columns)

    return run


def join_anti_null(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").select(F.expr("nullif(o_custkey, 1)").alias("k"))
    return table(spark, sf_dir, "customer").join(orders, F.col("c_custkey") == F.col("k"), "left_anti").select("c_custkey")


def join_theta(spark: SparkSession, sf_dir: str) -> DataFrame:
    n, r = table(spark, sf_dir, "nation"), table(spark, sf_dir, "region")
    return n.join(r, F.col("n_regionkey") < F.col("r_regionkey")).select("n_nationkey", "r_regionkey")


def agg_group_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").groupBy("o_orderstatus").agg(F.count("*").alias("n"))


def agg_query_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    views(spark, sf_dir, "orders")
    return read(spark).option("query", "select mod(o_custkey, 2) as m, count(*) as n from orders group by 1 order by 1").load()


def agg_sum_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(F.sum(money("l_extendedprice")).cast("decimal(28,2)").alias("total"))
    return table(spark, sf_dir, "orders").join(lines, F.col("o_orderkey") == F.col("l_orderkey")).select("o_orderkey", "o_custkey", "total")


def agg_distinct(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").select("o_orderstatus", "o_orderpriority").distinct()


def agg_count_distinct(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").groupBy("l_returnflag").agg(F.countDistinct("l_suppkey").alias("suppliers"))


def agg_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").rollup("o_orderstatus", "o_orderpriority").agg(F.count("*").alias("n"))


def agg_cube(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").cube("o_orderstatus", "o_orderpriority").agg(F.count("*").alias("n"))


def agg_pricing(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem").where("l_shipdate <= date '1998-09-02'")
    return lines.groupBy("l_returnflag", "l_linestatus").agg(
        F.sum(money("l_quantity")).cast("decimal(28,2)").alias("sum_qty"),
        F.sum(money("l_extendedprice")).cast("decimal(28,2)").alias("sum_base_price"),
        F.sum(money("l_extendedprice") * (1 - money("l_discount"))).cast("decimal(38,4)").alias("sum_disc_price"),
        F.count("*").alias("n"),
    )


def window_row_number(spark: SparkSession, sf_dir: str) -> DataFrame:
    last = Window.partitionBy("user_id").orderBy(F.col("ts").desc(), F.col("event_id").desc())
    return table(spark, sf_dir, "events").withColumn("rn", F.row_number().over(last).cast("long")).where("rn = 1").select("user_id", "event_id", "rn")


def window_running_sum(spark: SparkSession, sf_dir: str) -> DataFrame:
    upto = Window.partitionBy("o_custkey").orderBy("o_orderkey").rowsBetween(Window.unboundedPreceding, 0)
    return table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", F.sum(money("o_totalprice")).over(upto).cast("decimal(28,2)").alias("running"))


def window_rank(spark: SparkSession, sf_dir: str) -> DataFrame:
    by = Window.partitionBy("o_custkey").orderBy("o_orderstatus")
    full = Window.partitionBy("o_custkey").orderBy("o_orderkey")
    return table(spark, sf_dir, "orders").select(
        "o_orderkey", F.rank().over(by).cast("long").alias("r"), F.dense_rank().over(by).cast("long").alias("d"), F.lag("o_orderkey").over(full).alias("before"), F.lead("o_orderkey").over(full).alias("after")
    )


def sort_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").orderBy(F.col("o_totalprice").desc(), "o_orderkey").limit(100).select("o_orderkey", "o_custkey")


def union_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    return n.unionAll(n)


def union_distinct(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "customer").select("c_nationkey").union(table(spark, sf_dir, "supplier").select("s_nationkey")).distinct()


def set_intersect(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "customer").select("c_nationkey").intersect(table(spark, sf_dir, "supplier").select("s_nationkey"))


def set_except(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "customer").select("c_nationkey").exceptAll(table(spark, sf_dir, "supplier").select("s_nationkey"))


def project_rename(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "customer")
    return c.select(F.col("c_custkey").alias("id"), F.upper("c_name").alias("name"), (F.col("c_nationkey") * 10 + 1).cast("long").alias("code"))


def functions_mixed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").select(
        "o_orderkey",
        F.substring("o_orderpriority", 3, 4).alias("part"),
        F.year("o_orderdate").cast("long").alias("y"),
        F.length(F.concat_ws("-", "o_orderstatus", "o_orderpriority")).cast("long").alias("n"),
        F.element_at(F.array(F.lit("a"), F.lit("b"), F.lit("c")), (F.col("o_orderkey") % 3 + 1).cast("int")).alias("letter"),
        F.element_at(F.create_map(F.lit("F"), F.lit(1), F.lit("O"), F.lit(2)), F.lit("O")).cast("long").alias("m"),
    )


def checksum(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Equality of a table and its copy by the xor of row hashes, and what else can be told of the copy:
    the number of its rows and the xor of its whole numbers."""
    from tidewell.plans.scans import stored

    def of(df: DataFrame) -> DataFrame:
        keys = [F.bit_xor(c).alias(c) for c in ("l_orderkey", "l_partkey", "l_suppkey")]
        return df.agg(F.bit_xor(F.xxhash64(*df.columns)).alias("x"), F.count("*").alias("n"), *keys)

    before, after = of(table(spark, sf_dir, "lineitem")).select(F.col("x").alias("y")), of(stored(spark, sf_dir, "lineitem").load())
    return before.join(after, F.lit(True)).select((F.col("x") == F.col("y")).alias("same"), "n", "l_orderkey", "l_partkey", "l_suppkey")


def udf_scalar(spark: SparkSession, sf_dir: str) -> DataFrame:
    @F.pandas_udf(T.LongType())
    def square(x: pd.Series) -> pd.Series:
        return x * x

    return table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", square(F.col("l_linenumber").cast("long")).alias("sq"))


def udf_sql_scalar(spark: SparkSession, sf_dir: str) -> DataFrame:
    views(spark, sf_dir, "lineitem")
    spark.sql("CREATE OR REPLACE TEMPORARY FUNCTION tidewell_mul(a BIGINT, b BIGINT) RETURNS BIGINT RETURN a * b")
    return spark.sql("SELECT l_orderkey, l_linenumber, tidewell_mul(l_orderkey, l_linenumber) AS product FROM lineitem")


def udtf_sql(spark: SparkSession, sf_dir: str) -> DataFrame:
    views(spark, sf_dir, "orders")
    spark.sql("CREATE OR REPLACE TEMPORARY FUNCTION tidewell_orders_of(c BIGINT) RETURNS TABLE(o_orderkey BIGINT, o_orderstatus STRING) RETURN SELECT o_orderkey, o_orderstatus FROM orders WHERE o_custkey = c")
    return spark.sql("SELECT * FROM tidewell_orders_of(7)")


QUERIES = {
    "join_inner": joined("inner", "c_custkey", "o_orderkey"),
    "join_left": joined("left", "c_custkey", "o_orderkey"),
    "join_right": joined("right", "c_custkey", "o_orderkey"),
    "join_full": joined("full", "c_custkey", "o_orderkey"),
    "join_semi": joined("left_semi", "c_custkey"),
    "join_anti": joined("left_anti", "c_custkey"),
} | {
    f.__name__: f
    for f in (
        join_anti_null, join_theta, agg_group_count, agg_query_text, agg_sum_join, agg_distinct, agg_count_distinct, agg_rollup, agg_cube, agg_pricing, window_row_number,
        window_running_sum, window_rank, sort_topk, union_all, union_distinct, set_intersect, set_except, project_rename, functions_mixed, checksum, udf_scalar,
        udf_sql_scalar, udtf_sql,
    )
}
SUPPLY = "FROM customer c {} JOIN orders o ON c_custkey = nullif(o_custkey, 1)"
ORACLES = {
    "join_inner": "SELECT c_custkey, o_orderkey " + SUPPLY.format(""),
    "join_left": "SELECT c_custkey, o_orderkey " + SUPPLY.format("LEFT"),
    "join_right": "SELECT c_custkey, o_orderkey " + SUPPLY.format("RIGHT"),
    "join_full": "SELECT c_custkey, o_orderkey " + SUPPLY.format("FULL"),
    "join_semi": "SELECT c_custkey FROM customer WHERE EXISTS (SELECT 1 FROM orders WHERE nullif(o_custkey, 1) = c_custkey)",
    "join_anti": "SELECT c_custkey FROM customer WHERE NOT EXISTS (SELECT 1 FROM orders WHERE nullif(o_custkey, 1) = c_custkey)",
    "join_anti_null": "SELECT c_custkey FROM customer WHERE NOT EXISTS (SELECT 1 FROM orders WHERE nullif(o_custkey, 1) = c_custkey)",
    "join_theta": "SELECT n_nationkey, r_regionkey FROM nation JOIN region ON n_regionkey < r_regionkey",
    "agg_group_count": "SELECT o_orderstatus, count(*) AS n FROM orders GROUP BY o_orderstatus",
    "agg_query_text": "SELECT mod(o_custkey, 2) AS m, count(*) AS n FROM orders GROUP BY 1",
    "agg_sum_join": "SELECT o_orderkey, o_custkey, total FROM orders JOIN (SELECT l_orderkey, sum(l_extendedprice::DECIMAL(18,2))::DECIMAL(28,2) AS total FROM lineitem GROUP BY 1) ON o_orderkey = l_orderkey",
    "agg_distinct": "SELECT DISTINCT o_orderstatus, o_orderpriority FROM orders",
    "agg_count_distinct": "SELECT l_returnflag, count(DISTINCT l_suppkey) AS suppliers FROM lineitem GROUP BY l_returnflag",
    "agg_rollup": "SELECT o_orderstatus, o_orderpriority, count(*) AS n FROM orders GROUP BY ROLLUP (o_orderstatus, o_orderpriority)",
    "agg_cube": "SELECT o_orderstatus, o_orderpriority, count(*) AS n FROM orders GROUP BY CUBE (o_orderstatus, o_orderpriority)",
    "agg_pricing": """SELECT l_returnflag, l_linestatus, sum(l_quantity::DECIMAL(18,2))::DECIMAL(28,2) AS sum_qty, sum(l_extendedprice::DECIMAL(18,2))::DECIMAL(28,2) AS sum_base_price,
        sum(l_extendedprice::DECIMAL(18,2) * (1 - l_discount::DECIMAL(18,2)))::DECIMAL(38,4) AS sum_disc_price, count(*) AS n
        FROM lineitem WHERE l_shipdate <= DATE '1998-09-02' GROUP BY ALL""",
    "window_row_number": "SELECT user_id, event_id, rn FROM (SELECT user_id, event_id, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn FROM events) WHERE rn = 1",
    "window_running_sum": "SELECT o_orderkey, o_custkey, (sum(o_totalprice::DECIMAL(18,2)) OVER (PARTITION BY o_custkey ORDER BY o_orderkey ROWS UNBOUNDED PRECEDING))::DECIMAL(28,2) AS running FROM orders",
    "window_rank": "SELECT o_orderkey, rank() OVER b AS r, dense_rank() OVER b AS d, lag(o_orderkey) OVER f AS before, lead(o_orderkey) OVER f AS after FROM orders WINDOW b AS (PARTITION BY o_custkey ORDER BY o_orderstatus), f AS (PARTITION BY o_custkey ORDER BY o_orderkey)",
    "sort_topk": "SELECT o_orderkey, o_custkey FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 100",
    "union_all": "SELECT n_nationkey, n_name FROM nation UNION ALL SELECT n_nationkey, n_name FROM nation",
    "union_distinct": "SELECT c_nationkey FROM customer UNION SELECT s_nationkey FROM supplier",
    "set_intersect": "SELECT c_nationkey FROM customer INTERSECT SELECT s_nationkey FROM supplier",
    "set_except": "SELECT c_nationkey FROM customer EXCEPT ALL SELECT s_nationkey FROM supplier",
    "project_rename": "SELECT c_custkey AS id, upper(c_name) AS name, (c_nationkey * 10 + 1)::BIGINT AS code FROM customer",
    "functions_mixed": """SELECT o_orderkey, substring(o_orderpriority, 3, 4) AS part, year(o_orderdate)::BIGINT AS y, length(o_orderstatus || '-' || o_orderpriority)::BIGINT AS n,
        ['a', 'b', 'c'][(o_orderkey % 3 + 1)::INT] AS letter, 2::BIGINT AS m FROM orders""",
    "checksum": "SELECT true AS same, count(*) AS n, bit_xor(l_orderkey) AS l_orderkey, bit_xor(l_partkey) AS l_partkey, bit_xor(l_suppkey) AS l_suppkey FROM lineitem",
    "udf_scalar": "SELECT l_orderkey, l_linenumber, l_linenumber::BIGINT * l_linenumber AS sq FROM lineitem",
    "udf_sql_scalar": "SELECT l_orderkey, l_linenumber, l_orderkey * l_linenumber AS product FROM lineitem",
    "udtf_sql": "SELECT o_orderkey, o_orderstatus FROM orders WHERE o_custkey = 7",
}
