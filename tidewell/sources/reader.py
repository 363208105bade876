"""Reading tables, sub-queries and query text."""

from __future__ import annotations

import atexit
import time
import uuid
from contextlib import nullcontext

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql.types import StructType

from tidewell import runtime
from tidewell.functions import codec, predicates, types
from tidewell.functions.identifiers import read_name
from tidewell.options import Options
from tidewell.sources.files import Files
from tidewell.sources.store import Store, default_root


class Reader:
    """``Reader(spark).option("dbtable", "t").load()``: a lazy DataFrame. Filters and columns reach
    the Parquet scan by way of Catalyst."""

    def __init__(self, spark: SparkSession) -> None:
        self.spark = spark
        self._options: dict[str, object] = {}
        self._schema: StructType | None = None
        self._where: list = []
        self._jobs: runtime.Jobs | None = None
        runtime.register_redaction(spark)

    def option(self, name: str, value: object) -> Reader:
        self._options[name] = value
        return self

    def options(self, **values: object) -> Reader:
        self._options |= values
        return self

    def schema(self, schema: StructType | str) -> Reader:
        self._schema = StructType.fromDDL(schema) if isinstance(schema, str) else schema
        return self

    def where(self, *conditions: object) -> Reader:
        """Predicates as values, all of which must hold."""
        self._where += conditions
        return self

    def within(self, jobs: runtime.Jobs) -> Reader:
        """Read as one of these jobs, as far as reading runs jobs at once: closed ones refuse it."""
        self._jobs = jobs
        return self

    def load(self) -> DataFrame:
        began = time.monotonic()
        with self._jobs.running() if self._jobs else nullcontext():
            df = self._load()
        runtime.report("read", runtime.last_select() or "", began)
        return df

    def _load(self) -> DataFrame:
        o = Options.parse(self._options)
        kind, text = o.source
        partition_sizes(self.spark, o)
        with runtime.time_zone(self.spark, o.get("sftimezone")):
            runtime.run_actions(self.spark, o.get("preactions"), text if kind == "table" else None)
            df = self._source(o, kind, text)
            if o["treat_decimal_as_long"]:
                df = types.decimals_as_long(df)
            if self._schema is not None:
                df = types.with_schema(df, self._schema)
            for p in self._where:
                df = df.where(p if isinstance(p, Column) else predicates.column(p))
            runtime.note("select", self._text(o, kind, text, df))
            if o["use_copy_unload"]:
                df = staged(self.spark, df, o)
            runtime.run_actions(self.spark, o.get("postactions"), text if kind == "table" else None)
        return df

    def _source(self, o: Options, kind: str, text: str) -> DataFrame:
        if kind == "query":
            return self.spark.sql(text)
        store = Store(self.spark, o.get("warehouse_dir"))
        folder = store.folder(text, o["sfschema"])
        if store.manifest(folder) is None and self.spark.catalog.tableExists(text):
            return self.spark.table(text)
        if o["verify_rows"]:
            store.verify(folder)
        df = store.scan(folder)
        keep = o["keep_column_case"]
        names = [read_name(n, keep) for n in df.columns]
        return df.toDF(*names) if names != df.columns else df

    def _text(self, o: Options, kind: str, text: str, df: DataFrame) -> str:
        columns = ", ".join(predicates.quote(c) if o["keep_column_case"] else c for c in df.columns)
        plain = [p for p in self._where if not isinstance(p, Column)]
        where = predicates.where(plain, df.schema, o["keep_column_case"])
        return f"SELECT {columns} FROM {text if kind == 'table' else f'({text})'} {where}".strip()


def partition_sizes(spark: SparkSession, o: Options) -> None:
    """``partition_size_in_mb`` and ``expected_partition_count``, where given. Spark takes the size of scan
    partitions from the session when a query is planned, so they are set there and stay."""
    if "partition_size_in_mb" in o.given:
        spark.conf.set("spark.sql.files.maxPartitionBytes", f"{o['partition_size_in_mb']}m")
    if "expected_partition_count" in o.given:
        spark.conf.set("spark.sql.files.minPartitionNum", str(o["expected_partition_count"]))


def staged(spark: SparkSession, df: DataFrame, o: Options) -> DataFrame:
    """The rows by way of files in the stage: CSV or JSON by the schema, so an empty string comes
    back as null from CSV. A stage of the user's own is kept, any other goes when the driver ends."""
    root = o.get("stage_dir") or o.get("tempdir") or default_root(spark) + "/_stage"
    name = f"unload-{uuid.uuid4().hex}"
    Files(spark, root).make("")
    path = f"{root.rstrip('/')}/{name}"
    if "stage_dir" not in o.given:
        atexit.register(drop_stage, spark, root, name)
    if codec.unload_format(df.schema) == "json":
        codec.write_json(df, path, o["compress"], o["s3maxfilesize"])
        return codec.read_json(spark, path, df.schema)
    codec.write_csv(df, path, o["compress"], o["s3maxfilesize"])
    return codec.read_csv(spark, path, df.schema)


def drop_stage(spark: SparkSession, root: str, name: str) -> bool:
    """Remove what a staged read has left, and say whether there was anything. The result is lazy, so this
    happens when the driver ends, or when a caller who has read it all asks for it."""
    try:
        files = Files(spark, root)
        there = files.exists(name)
        files.delete(name)
    except Exception:  # noqa: BLE001  the session may have ended
        return False
    return there
