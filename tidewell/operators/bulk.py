"""Bulk-load rules on DataFrames: text limits, bad rows, timestamps in text."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructType, TimestampNTZType, TimestampType, VariantType

from tidewell.functions.codec import translate_format
from tidewell.functions.types import quoted


def limit_text(df: DataFrame, cut: bool) -> DataFrame:
    """Columns with a ``maxlength``: longer text is cut, or else an error."""
    out = {}
    for f in df.schema:
        most = (f.metadata or {}).get("maxlength")
        if most and isinstance(f.dataType, StringType):
            c = F.col(quoted(f.name))
            too_long = F.raise_error(F.concat(F.lit(f"{f.name} is longer than {most}: "), F.substring(c, 1, 40)))
            fit = F.substring(c, 1, int(most)) if cut else F.when(F.length(c) > int(most), too_long.cast("string")).otherwise(c)
            out[f.name] = fit.alias(f.name, metadata=f.metadata)
    return df.select(*[out.get(f.name, F.col(quoted(f.name))) for f in df.schema])


def text_as(df: DataFrame, schema: StructType, timestamp_format: str | None, skip_bad: bool) -> DataFrame:
    """Text columns as what the table has there: timestamps by a format, variants from JSON. With
    ``skip_bad`` rows that don't parse are left out, else they are an error. A DataFrame that has a
    timestamp of its own is not parsed by the format."""
    kinds = {f.name: f.dataType for f in schema}
    own = any(isinstance(f.dataType, (TimestampType, TimestampNTZType)) for f in df.schema)
    columns, bad = [], F.lit(False)
    for f in df.schema:
        c, want = F.col(quoted(f.name)), kinds.get(f.name, f.dataType)
        if not isinstance(f.dataType, StringType) or isinstance(want, StringType):
            columns.append(c)
            continue
        if isinstance(want, VariantType):
            tried, strict = F.try_parse_json(c), F.parse_json(c)
        elif isinstance(want, (TimestampType, TimestampNTZType)) and timestamp_format and not own:
            pattern = F.lit(translate_format(timestamp_format))
            tried, strict = F.try_to_timestamp(c, pattern).cast(want), F.to_timestamp(c, translate_format(timestamp_format)).cast(want)
        else:
            tried, strict = c.try_cast(want), c.cast(want)
        bad = bad | (c.isNotNull() & tried.isNull())
        columns.append((tried if skip_bad else strict).alias(f.name))
    return (df.where(~bad) if skip_bad else df).select(*columns)
