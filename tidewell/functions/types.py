"""Column types: definitions for tables, and the types that reading gives."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

_SIMPLE = {
    T.ByteType: "INTEGER", T.ShortType: "INTEGER", T.IntegerType: "INTEGER", T.LongType: "INTEGER", T.FloatType: "FLOAT", T.DoubleType: "DOUBLE",
    T.BooleanType: "BOOLEAN", T.DateType: "DATE", T.TimestampType: "TIMESTAMP", T.TimestampNTZType: "TIMESTAMP_NTZ", T.VariantType: "VARIANT",
    T.ArrayType: "VARIANT", T.MapType: "VARIANT", T.StructType: "VARIANT",
}
NESTED = (T.ArrayType, T.MapType, T.StructType, T.VariantType)


class UnsupportedType(TypeError):
    """A column has a type that tables can't hold."""


def definition(field: T.StructField) -> str:
    """The type of a column in a table definition."""
    kind, most = field.dataType, (field.metadata or {}).get("maxlength")
    if isinstance(kind, T.StringType):
        return f"VARCHAR({most})" if most else "STRING"
    if isinstance(kind, T.BinaryType):
        return f"BINARY({most})" if most else "BINARY"
    if isinstance(kind, T.DecimalType):
        return f"DECIMAL({kind.precision},{kind.scale})"
    if isinstance(kind, T.MapType) and not isinstance(kind.keyType, T.StringType):
        raise UnsupportedType(f"{field.name}: the keys of a map must be strings")
    if type(kind) not in _SIMPLE:
        raise UnsupportedType(f"{field.name}: {kind.simpleString()} can't be stored")
    return _SIMPLE[type(kind)]


def definitions(schema: T.StructType) -> str:
    return ", ".join(f'"{f.name}" {definition(f)}{"" if f.nullable else " NOT NULL"}' for f in schema)


def clamped_decimal(precision: int, scale: int) -> T.DecimalType:
    """A wider decimal than Spark has keeps its whole digits as far as possible."""
    if precision == scale == 0:
        return T.DecimalType(38, 18)
    if precision <= 38:
        return T.DecimalType(precision, scale)
    cut = scale + (38 - precision)
    if not 0 <= cut <= 38:
        raise UnsupportedType(f"decimal({precision},{scale}) doesn't fit 38 digits")
    return T.DecimalType(38, cut)


def decimals_as_long(df: DataFrame) -> DataFrame:
    """Whole decimals as long; a value beyond long is an error."""
    whole = [f.name for f in df.schema if isinstance(f.dataType, T.DecimalType) and f.dataType.scale == 0]
    return df.select(*[F.col(quoted(f.name)).cast("long").alias(f.name) if f.name in whole else F.col(quoted(f.name)) for f in df.schema])


def quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def has_nested(schema: T.StructType) -> bool:
    return any(isinstance(f.dataType, NESTED) for f in schema)


def decoded(column: Column, have: T.DataType, want: T.DataType) -> Column:
    """A column as the type that the reader's schema asks for: JSON text becomes nested, anything
    else is cast."""
    if have == want:
        return column
    if isinstance(want, T.VariantType) and isinstance(have, T.StringType):
        return F.parse_json(column)
    if isinstance(want, (T.ArrayType, T.MapType, T.StructType)) and isinstance(have, T.StringType):
        return F.from_json(column, want, {"mode": "FAILFAST"})
    return column.cast(want)


def with_schema(df: DataFrame, schema: T.StructType) -> DataFrame:
    """The columns of a schema, by name, in its order and of its types."""
    names = {n.lower(): n for n in df.columns}
    missing = [f.name for f in schema if f.name.lower() not in names]
    if missing:
        raise ValueError(f"no such columns: {', '.join(missing)}")
    of = {f.name: f.dataType for f in df.schema}
    return df.select(*[decoded(F.col(quoted(names[f.name.lower()])), of[names[f.name.lower()]], f.dataType).alias(f.name) for f in schema])
