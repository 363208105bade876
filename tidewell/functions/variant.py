"""Semi-structured values: text to variant, null rules, access and construction."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def materialise(text: Column, nullable: bool = True) -> Column:
    """JSON text as a variant. Blank text is null, or an error in a column that can't be null; the
    JSON text null is a value. A string that itself holds an object or array is unwrapped once."""
    blank = F.trim(text) == ""
    empty = F.lit(None) if nullable else F.raise_error(F.lit("blank text in a variant column that can't be null"))
    value = F.when(blank, F.parse_json(empty.cast("string"))).otherwise(F.parse_json(text))
    return unwrapped(value)


def unwrapped(value: Column) -> Column:
    inner = F.trim(F.try_variant_get(value, "$", "string"))
    looks = F.regexp_like(inner, F.lit(r"(?s)^(\{.*\}|\[.*\])$"))
    return F.when((F.schema_of_variant(value) == "STRING") & looks, F.coalesce(F.try_parse_json(inner), value)).otherwise(value)


def get(value: Column, path: str, kind: str, strict: bool = False) -> Column:
    return (F.variant_get if strict else F.try_variant_get)(value, path, kind)


def json_null_as_null(value: Column) -> Column:
    """What a read through JSON files gives: a JSON null is null."""
    return F.when(~F.is_variant_null(value), value)


def record(**fields: Column) -> Column:
    """An object of the given fields."""
    return F.to_variant_object(F.struct(*[c.alias(n) for n, c in fields.items()]))
