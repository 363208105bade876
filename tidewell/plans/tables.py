"""Input tables for the queries, and scratch warehouses for those that write."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def views(spark: SparkSession, sf_dir: str, *names: str) -> None:
    """Make tables known to SQL text."""
    for n in names:
        table(spark, sf_dir, n).createOrReplaceTempView(n)


def scratch(spark: SparkSession) -> str:
    """A folder for a query's own tables: in the shared folder that the session names, or below this
    machine's temporary one in local runs. It must outlive the lazy result, so it goes at exit."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return f"{root.rstrip('/')}/warehouse-{uuid.uuid4().hex}"
    if not spark.sparkContext.master.startswith("local"):
        return spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + f"/scratch-{uuid.uuid4().hex}"
    path = tempfile.mkdtemp(prefix="tidewell-warehouse-")
    atexit.register(shutil.rmtree, path, True)
    return f"file://{path}"
