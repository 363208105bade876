"""Which columns of a DataFrame go to which columns of a table."""

from __future__ import annotations

from collections import Counter
from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tidewell.functions.identifiers import stored_name
from tidewell.functions.types import quoted


class MappingError(ValueError):
    """Columns can't be matched."""


def by_name(own: list[str], table: list[str], strict: bool) -> dict[str, str]:
    """Columns of the same name, whatever its case. Names that differ in case only are an error if
    the other side has such a name; with ``strict``, so is any column without a counterpart."""
    for what, names, others in (("DataFrame", own, table), ("table", table, own)):
        there = {n.lower() for n in others}
        twice = [n for n, k in Counter(x.lower() for x in names).items() if k > 1 and n in there]
        if twice:
            raise MappingError(f"column names of the {what} differ in case only: {', '.join(sorted(twice))}")
    target = {n.lower(): n for n in table}
    if strict and len({n.lower() for n in own}) != len(target):
        raise MappingError(f"the DataFrame has {len(own)} columns, the table {len(target)}")
    found = {n: target[n.lower()] for n in own if n.lower() in target}
    if strict and len(found) < len(own):
        raise MappingError(f"the table has no column {', '.join(n for n in own if n not in found)}")
    if not found:
        raise MappingError("no column of the DataFrame is in the table")
    return found


def explicit(pairs: Mapping[str, str], own: list[str], table: list[str]) -> dict[str, str]:
    """A given map; both sides must exist. A bare table column is upper-case, as in table names."""
    out = {}
    for source, target in pairs.items():
        if source not in own:
            raise MappingError(f"the DataFrame has no column {source}")
        name = target if target in table else stored_name(target)
        if name not in table:
            raise MappingError(f"the table has no column {target}")
        out[source] = name
    return out


def aligned(df: DataFrame, schema: StructType, pairs: Mapping[str, str]) -> DataFrame:
    """The table's columns in its order and types; columns that nothing is mapped to are null."""
    source = {t: s for s, t in pairs.items()}
    return df.select(*[(F.col(quoted(source[f.name])).cast(f.dataType) if f.name in source else F.lit(None).cast(f.dataType)).alias(f.name) for f in schema])


def by_order(df: DataFrame, schema: StructType) -> DataFrame:
    if len(df.columns) != len(schema):
        raise MappingError(f"the DataFrame has {len(df.columns)} columns, the table {len(schema)}")
    flat = df.toDF(*[f"_c{i}" for i in range(len(df.columns))])
    return flat.select(*[F.col(f"_c{i}").cast(f.dataType).alias(f.name) for i, f in enumerate(schema)])
