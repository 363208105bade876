"""A catalog that falls back to a second one where the first denies access."""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tidewell.sources.reader import Reader
from tidewell.sources.store import Store

#: How a refusal shows in an error or its causes.
_DENIED = re.compile(r"\b403\b|forbidden", re.I)


def denied(error: BaseException | None) -> bool:
    seen = set()
    while error is not None and id(error) not in seen:
        seen.add(id(error))
        if isinstance(error, PermissionError) or _DENIED.search(str(error)):
            return True
        error = error.__cause__ or error.__context__
    return False


class FallbackCatalog:
    """Loads by ``primary``; only where that is refused, by ``fallback``. If that fails too, the
    first error is what the caller sees. All else goes to Spark's catalog."""

    def __init__(self, spark: SparkSession, primary: Callable[[str], DataFrame] | None = None, fallback: Callable[[str], DataFrame] | None = None) -> None:
        self.spark = spark
        self.primary = primary or spark.table
        self.fallback = fallback or (lambda name: Reader(spark).option("dbtable", name).load())

    def load(self, *name: str) -> DataFrame:
        full = ".".join(name)
        try:
            return self.primary(full)
        except Exception as first:
            if not denied(first):
                raise
            try:
                return self.fallback(full)
            except Exception:
                raise first from None

    def exists(self, name: str) -> bool:
        try:
            return bool(self.spark.catalog.tableExists(name))
        except Exception:  # noqa: BLE001  an error here means that the table can't be used
            return False

    def tables(self, namespace: str | None = None) -> list[str]:
        return sorted(t.name for t in self.spark.catalog.listTables(namespace))

    def namespaces(self) -> list[str]:
        return sorted(d.name for d in self.spark.catalog.listDatabases())

    def functions(self, namespace: str | None = None) -> list[str]:
        return sorted(f.name for f in self.spark.catalog.listFunctions(namespace))

    def create(self, name: str, df: DataFrame) -> None:
        df.limit(0).write.saveAsTable(name)

    def drop(self, name: str) -> bool:
        there = self.exists(name)
        self.spark.sql(f"DROP TABLE IF EXISTS {name}")
        return there

    def rename(self, old: str, new: str) -> None:
        self.spark.sql(f"ALTER TABLE {old} RENAME TO {new}")

    def add_column(self, name: str, column: str, kind: str) -> None:
        self.spark.sql(f"ALTER TABLE {name} ADD COLUMNS ({column} {kind})")


def run_query(spark: SparkSession, text: str):
    """Rows of a query, one partition at a time."""
    return spark.sql(text.strip().rstrip(";")).toLocalIterator()


def print_query(spark: SparkSession, text: str, rows: int = 20) -> None:
    """Show the first rows of a query; the limit is part of the plan."""
    spark.sql(text.strip().rstrip(";")).show(rows, truncate=False)


def stored_tables(spark: SparkSession, schema: str = "PUBLIC", root: str | None = None) -> list[str]:
    return Store(spark, root).tables(schema)
