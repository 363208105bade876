"""Writing tables: save modes, overwrite strategies, column mapping, load options."""

from __future__ import annotations

import hashlib
import logging
import time
from collections.abc import Mapping
from contextlib import nullcontext

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from tidewell import runtime
from tidewell.functions import codec, types
from tidewell.functions.identifiers import stored_name
from tidewell.operators import bulk, mapping
from tidewell.options import OptionError, Options
from tidewell.sources.store import Manifest, Store, TableExists

log = logging.getLogger(__name__)
MODES = ("append", "overwrite", "error", "errorifexists", "ignore")


class Writer:
    """``Writer(df).option("dbtable", "t").mode("append").save()``"""

    def __init__(self, df: DataFrame) -> None:
        self.df, self.spark = df, df.sparkSession
        self._options: dict[str, object] = {}
        self._mode = "error"
        self._jobs: runtime.Jobs | None = None
        runtime.register_redaction(self.spark)

    def option(self, name: str, value: object) -> Writer:
        self._options[name] = value
        return self

    def options(self, **values: object) -> Writer:
        self._options |= values
        return self

    def mode(self, mode: str) -> Writer:
        if mode.lower() not in MODES:
            raise OptionError(f"mode must be one of {MODES}")
        self._mode = mode.lower()
        return self

    def within(self, jobs: runtime.Jobs) -> Writer:
        """Write as one of these jobs: closing them cancels it, and closed ones refuse it."""
        self._jobs = jobs
        return self

    def insert(self, overwrite: bool = False) -> int:
        return self.mode("overwrite" if overwrite else "append").save()

    def save(self) -> int:
        """Write, and return the number of rows written."""
        o = Options.parse(self._options)
        kind, name = o.source
        if kind != "table":
            raise OptionError("a table to write to is needed: dbtable")
        if o.column_map and self._mode != "append":
            raise OptionError("a column map needs the mode append")
        store = Store(self.spark, o.get("warehouse_dir"))
        folder = store.folder(name, o["sfschema"])
        now = store.manifest(folder)
        if now and self._mode == "ignore":
            return 0
        if now and self._mode in ("error", "errorifexists"):
            raise TableExists(name)
        began = time.monotonic()
        try:
            with runtime.time_zone(self.spark, o.get("sftimezone")), self._jobs.running() if self._jobs else nullcontext():
                n = self._write(store, folder, name, now, o)
        except BaseException as error:
            runtime.report("write", name, began, error=error)
            raise
        runtime.report("write", name, began, n)
        return n

    def _write(self, store: Store, folder: str, name: str, now: Manifest | None, o: Options) -> int:
        df, empty_skip = self.df, o["internal_skip_write_when_writing_empty_dataframe"]
        if empty_skip and df.isEmpty():
            return 0
        own = table_schema(df.schema, o["keep_column_case"])
        fresh = now is None or self._mode == "overwrite" and not o["truncate_table"]
        schema = own if fresh else now.struct
        rows = prepared(df, schema, fresh, o)
        # All strategies share one way: a new version is written first and then becomes the table, or
        # a part of it, in one step. So a failure at any point leaves the table as it was.
        runtime.run_actions(self.spark, o.get("preactions"), name)
        load = load_key(o.get("load_id")) if self._mode == "append" else ()
        if load and now and load[0] in now.loaded and not o["force"]:
            log.info("%s: the load %s has been done before", name, o.get("load_id"))
            return 0
        version, n = store.write_version(folder, rows, o["max_records_per_file"])
        try:
            runtime.note("load", f"COPY INTO {name} FROM {version} ({codec.write_format(df.schema, o['use_parquet_in_write'], o['use_json_in_structured_data'])})")
            # The manifest is what commits a write, so actions go before it: one that fails undoes the write.
            runtime.reached("before_post_actions")
            runtime.run_actions(self.spark, o.get("postactions"), name)
            if self._mode == "overwrite" or now is None:
                store.swap(folder, schema, version, n, load)
            else:
                store.append(folder, version, n, load)
        except BaseException:
            store.drop_version(folder, version)
            raise
        return n


def table_schema(schema: StructType, keep_case: bool) -> StructType:
    """What a table made from these columns looks like; types that it can't hold are an error."""
    out = StructType([StructField(stored_name(f.name, keep_case), f.dataType, f.nullable, f.metadata) for f in schema])
    types.definitions(out)
    return out


def prepared(df: DataFrame, schema: StructType, fresh: bool, o: Options) -> DataFrame:
    """Rows as the table takes them."""
    limited = bulk.limit_text(df, o["truncate_columns"])
    if o["trim_space"]:
        limited = codec.trim_strings(limited)
    keep = o["keep_column_case"]
    if fresh:
        return limited.toDF(*[stored_name(c, keep) for c in df.columns])
    if o.column_map:
        pairs: Mapping[str, str] = mapping.explicit(o.column_map, df.columns, schema.names)
    elif o["column_mapping"] == "name":
        pairs = mapping.by_name(df.columns, schema.names, o["column_mismatch_behavior"] == "error")
    else:
        named = limited.toDF(*schema.names) if len(df.columns) == len(schema) else limited
        parsed = bulk.text_as(named, schema, o.get("string_timestamp_format"), o["continue_on_error"]) if named is not limited else limited
        return mapping.by_order(parsed, schema)
    renamed = limited.select(*[F.col(types.quoted(s)).alias(t) for s, t in pairs.items()])
    parsed = bulk.text_as(renamed, schema, o.get("string_timestamp_format"), o["continue_on_error"])
    return mapping.aligned(parsed, schema, {t: t for t in pairs.values()})


def load_key(load_id: str | None) -> tuple[str, ...]:
    """What a table remembers of a load that its caller has named: the same in every session. Rows are
    never taken for the same because of the files that they come from."""
    return (hashlib.sha256(load_id.encode()).hexdigest(),) if load_id else ()
