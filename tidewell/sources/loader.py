"""Loading staged files into a table.

``Loader(spark).options(dbtable="t", stage_dir=folder).load()`` appends the rows of all files below the
stage that the table has not taken yet. A table remembers what it has taken by a digest of path, size and
time of each file, in the commit that adds the rows, so a load that failed or ran twice adds them once.
``files`` names the files to take (a comma between), ``force`` takes them again, ``purge`` deletes the taken
files once their rows are committed, and ``continue_on_error`` leaves out rows that don't fit the table.
"""

from __future__ import annotations

import hashlib
import time
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from tidewell import runtime
from tidewell.functions import codec
from tidewell.functions.types import quoted
from tidewell.operators import bulk, mapping
from tidewell.options import OptionError, Options
from tidewell.sources.files import Files, StagedFile
from tidewell.sources.store import Store

FORMATS = {".parquet": "parquet", ".json": "json", ".json.gz": "json", ".txt": "json", ".txt.gz": "json", ".csv": "csv", ".csv.gz": "csv"}


class MissingFile(LookupError):
    """A file that was asked for is not in the stage."""


@dataclass(frozen=True)
class Loaded:
    """What a load has done: rows added, files taken, and files left out as they were taken before."""

    rows: int
    files: tuple[str, ...]
    skipped: tuple[str, ...]


def digest(file: StagedFile) -> str:
    return hashlib.sha256(f"{file.path}\0{file.size}\0{file.modified}".encode()).hexdigest()


class Loader:
    def __init__(self, spark: SparkSession) -> None:
        self.spark, self._options = spark, {}
        runtime.register_redaction(spark)

    def option(self, name: str, value: object) -> Loader:
        return self.options(**{name: value})

    def options(self, **values: object) -> Loader:
        self._options |= values
        return self

    def load(self) -> Loaded:
        o, began = Options.parse(self._options), time.monotonic()
        kind, name = o.source
        if kind != "table" or not o.get("stage_dir"):
            raise OptionError("a load needs dbtable and stage_dir")
        store = Store(self.spark, o.get("warehouse_dir"))
        folder = store.folder(name, o["sfschema"])
        now, stage = store.need(folder), Files(self.spark, o["stage_dir"])
        found = self._wanted(stage, o.get("files"))
        done = set() if o["force"] else set(now.loaded)
        take = [f for f in found if digest(f) not in done]
        skipped = tuple(f.name for f in found if digest(f) in done)
        if not take:
            return Loaded(0, (), skipped)
        kinds: dict[str, list[str]] = {}
        for f in take:
            kinds.setdefault(file_format(f.name), []).append(f.path)
        rows = None
        for form, paths in sorted(kinds.items()):
            part = staged_rows(self.spark, form, paths, now.struct, o["continue_on_error"])
            rows = part if rows is None else rows.unionAll(part)
        if o["trim_space"]:
            rows = codec.trim_strings(rows)
        runtime.note("load", f"COPY INTO {name} FROM {', '.join(f.name for f in take)}")
        version, n = store.write_version(folder, rows, o["max_records_per_file"])
        try:
            store.append(folder, version, n, tuple(digest(f) for f in take))
        except BaseException:
            store.drop_version(folder, version)
            raise
        if o["purge"]:
            for f in take:
                stage.delete(f.name)
        runtime.report("load", name, began, n)
        return Loaded(n, tuple(f.name for f in take), skipped)

    @staticmethod
    def _wanted(stage: Files, names: str | None) -> list[StagedFile]:
        every = {f.name: f for f in stage.tree() if not f.name.rpartition("/")[2].startswith(("_", "."))}
        if names is None:
            return list(every.values())
        asked = [n.strip() for n in names.split(",") if n.strip()]
        if missing := [n for n in asked if n not in every]:
            raise MissingFile(", ".join(missing))
        return [every[n] for n in dict.fromkeys(asked)]


def file_format(name: str) -> str:
    for end, form in FORMATS.items():
        if name.endswith(end):
            return form
    raise OptionError(f"no known format of staged files: {name}")


def staged_rows(spark: SparkSession, form: str, paths: list[str], schema: StructType, skip_bad: bool) -> DataFrame:
    """The rows of staged files in the table's columns and types."""
    if form == "json":
        return codec.read_json(spark, paths, schema)
    if form == "csv":
        if not skip_bad:
            return codec.read_csv(spark, paths, schema)
        text = codec.read_csv(spark, paths, StructType([StructField(f.name, StringType()) for f in schema]))
        return bulk.text_as(text, schema, None, True)
    rows = spark.read.parquet(*paths)
    names = {c.lower(): c for c in rows.columns}
    if all(f.name.lower() in names for f in schema):
        return rows.select(*[F.col(quoted(names[f.name.lower()])).cast(f.dataType).alias(f.name) for f in schema])
    return mapping.by_order(rows, schema)
