"""Staged text and JSON: encoding and decoding as Spark expressions and file sources."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewell.functions.types import NESTED, has_nested, quoted

CSV = {"sep": "|", "quote": '"', "escape": '"', "multiLine": "true", "header": "false"}
#: Timestamps in staged text: an offset, then nanoseconds; reading keeps milliseconds.
TIMESTAMP_OUT = "XX yyyy-MM-dd HH:mm:ss.SSSSSSSSS"
_NAMES_WITH_MARKS = re.compile(r"[:;,\s]")
CONTROL_OR_SPACE = r"^[\x00-\x20]+|[\x00-\x20]+$"


def unload_format(schema: T.StructType) -> str:
    """JSON if a column is nested and no name has a sign that JSON paths stumble over, else CSV."""
    plain = not any(_NAMES_WITH_MARKS.search(f.name) for f in schema)
    return "json" if has_nested(schema) and plain else "csv"


def write_format(schema: T.StructType, parquet: bool = False, json_for_nested: bool = False) -> str:
    if parquet:
        return "parquet"
    if has_nested(schema):
        return "json" if json_for_nested else "parquet"
    return "csv"


def trimmed(column: Column) -> Column:
    """Without control characters and spaces at both ends; null stays null."""
    return F.regexp_replace(column, CONTROL_OR_SPACE, "")


def trim_strings(df: DataFrame) -> DataFrame:
    strings = {f.name: trimmed(F.col(quoted(f.name))) for f in df.schema if isinstance(f.dataType, T.StringType)}
    return df.withColumns(strings) if strings else df


def as_text(field: T.StructField) -> Column:
    """A cell of staged text."""
    c, kind = F.col(quoted(field.name)), field.dataType
    if isinstance(kind, T.BinaryType):
        return F.base64(c)
    if isinstance(kind, T.TimestampType):
        return F.date_format(c, TIMESTAMP_OUT)
    if isinstance(kind, T.TimestampNTZType):
        return F.date_format(c, TIMESTAMP_OUT.removeprefix("XX "))
    if isinstance(kind, T.DateType):
        return F.date_format(c, "yyyy-MM-dd")
    if isinstance(kind, NESTED):
        return F.to_json(c)
    return c.cast("string")


def parse_timestamp(c: Column, ntz: bool) -> Column:
    """Milliseconds are kept; text behind them is ignored; an offset in front counts."""
    offset = F.regexp_like(c, F.lit("^([+-]|Z )"))
    with_offset = F.to_timestamp(F.regexp_extract(c, r"^(\S+ .{23})", 1), "XX yyyy-MM-dd HH:mm:ss.SSS")
    if ntz:
        return F.when(offset, F.to_timestamp_ntz(F.substr(c, F.instr(c, " ") + 1, F.lit(23)), F.lit("yyyy-MM-dd HH:mm:ss.SSS"))).otherwise(
            F.to_timestamp_ntz(F.substring(c, 1, 23), F.lit("yyyy-MM-dd HH:mm:ss.SSS"))
        )
    return F.when(offset, with_offset).otherwise(F.to_timestamp(F.substring(c, 1, 23), "yyyy-MM-dd HH:mm:ss.SSS"))


def from_text(field: T.StructField) -> Column:
    """A typed cell. In a column that can't be null an empty cell is an empty string."""
    c, kind = F.col(quoted(field.name)), field.dataType
    if not field.nullable:
        c = F.coalesce(c, F.lit(""))
    if isinstance(kind, T.StringType):
        return c
    if isinstance(kind, T.BinaryType):
        return F.unbase64(c)
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
        return parse_timestamp(c, isinstance(kind, T.TimestampNTZType))
    if isinstance(kind, T.BooleanType):
        return F.when(c == "true", True).when(c == "false", False).when(c.isNull(), None).otherwise(F.raise_error(F.lit("neither true nor false")))
    if isinstance(kind, T.VariantType):
        return F.parse_json(c)
    if isinstance(kind, (T.ArrayType, T.MapType, T.StructType)):
        return F.from_json(c, kind, {"mode": "FAILFAST"})
    return c.cast(kind)


def records_of(cells: DataFrame, max_bytes: int) -> int:
    """How many records a file may have so that it is of about this size before compression, by the mean
    length of all records: quoted text can't be split, so a file is what a task reads later. 0: no bound."""
    if not max_bytes:
        return 0
    length = sum((F.coalesce(F.octet_length(F.col(quoted(c))), F.lit(0)) + 3 for c in cells.columns), F.lit(0))
    mean = cells.agg(F.avg(length)).first()[0]
    return max(1, int(max_bytes / mean)) if mean else 0


def write_csv(df: DataFrame, path: str, compress: bool = True, max_bytes: int = 0) -> None:
    """Staged text; with ``max_bytes`` in files of about that size at most."""
    cells = df.select(*[as_text(f).alias(f"c{i}") for i, f in enumerate(df.schema)])
    cells.write.option("maxRecordsPerFile", records_of(cells, max_bytes)).options(**CSV | {"quoteAll": "true", "emptyValue": "", "nullValue": "", "compression": "gzip" if compress else "none"}).csv(path)


def read_csv(spark: SparkSession, path: str | list[str], schema: T.StructType) -> DataFrame:
    text = T.StructType([T.StructField(f.name, T.StringType()) for f in schema])
    cells = spark.read.schema(text).options(**CSV | {"nullValue": "", "emptyValue": ""}).csv(path)
    cells = cells.select(*[F.when(F.col(quoted(n)) != "", F.col(quoted(n))).alias(n) for n in cells.columns])
    return cells.select(*[from_text(f).alias(f.name) for f in schema])


def json_ready(df: DataFrame) -> DataFrame:
    """Binary as base64 text, null binary as an empty one."""
    return df.select(*[F.coalesce(F.base64(F.col(quoted(f.name))), F.lit("")).alias(f.name) if isinstance(f.dataType, T.BinaryType) else F.col(quoted(f.name)) for f in df.schema])


def write_json(df: DataFrame, path: str, compress: bool = True, max_bytes: int = 0) -> None:
    """One object for each line, nulls included."""
    rows = json_ready(df).select(F.to_json(F.struct(*[F.col(quoted(c)) for c in df.columns]), {"ignoreNullFields": "false"}).alias("value"))
    rows.write.option("maxRecordsPerFile", records_of(rows, max_bytes)).option("compression", "gzip" if compress else "none").text(path)


def read_json(spark: SparkSession, path: str | list[str], schema: T.StructType) -> DataFrame:
    text = T.StructType([T.StructField(f.name, T.StringType() if isinstance(f.dataType, T.BinaryType) else f.dataType, True) for f in schema])
    rows = spark.read.text(path).select(F.from_json("value", text, {"mode": "FAILFAST"}).alias("r")).select("r.*")
    return rows.select(*[F.unbase64(F.col(quoted(f.name))).alias(f.name) if isinstance(f.dataType, T.BinaryType) else F.col(quoted(f.name)) for f in schema])


def translate_format(pattern: str) -> str:
    """A warehouse timestamp format as a Spark one."""
    rules = (("YYYY", "yyyy"), ("YY", "yy"), ("DD", "dd"), ("HH24", "HH"), ("HH12", "hh"), ("AM", "a"), ("PM", "a"), ("MI", "mm"), ("SS", "ss"), ("TZHTZM", "XX"), ("TZH:TZM", "XXX"))
    out = pattern
    for theirs, ours in rules:
        out = out.replace(theirs, ours)
    return re.sub(r"FF(\d?)", lambda m: "S" * int(m[1] or 9), out)
