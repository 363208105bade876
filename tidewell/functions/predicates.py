"""Predicates as values: to a Column for execution, to text for people.

Execution always goes through Columns, so Catalyst pushes down what it can and checks every row;
the text is what ``runtime.last_select`` shows.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass
from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tidewell.functions.identifiers import quote
from tidewell.functions.types import quoted

_SIGNS = {"=": "eq", "<": "lt", ">": "gt", "<=": "le", ">=": "ge"}
_TEXTS = {"starts": ("STARTSWITH", "startswith"), "ends": ("ENDSWITH", "endswith"), "contains": ("CONTAINS", "contains")}


@dataclass(frozen=True)
class Compare:
    """sign: = < > <= >=, or <=> (which has no text)."""

    column: str
    sign: str
    value: object


@dataclass(frozen=True)
class In:
    column: str
    values: tuple


@dataclass(frozen=True)
class Null:
    column: str
    wanted: bool = True


@dataclass(frozen=True)
class Text:
    """how: starts, ends or contains."""

    column: str
    how: str
    value: str


@dataclass(frozen=True)
class Like:
    column: str
    pattern: str
    escape: str = "\\"


@dataclass(frozen=True)
class Both:
    left: object
    right: object


@dataclass(frozen=True)
class Either:
    left: object
    right: object


@dataclass(frozen=True)
class Not:
    inner: object


def segments(pattern: str, escape: str) -> list[str] | None:
    """What stands between the percent signs of a pattern, or None if it has other wildcards."""
    out, at = [""], 0
    while at < len(pattern):
        sign = pattern[at]
        if sign == escape and pattern[at + 1 : at + 2] in ("%", "_", escape):
            out[-1] += pattern[at + 1]
            at += 2
            continue
        if sign in ("_", escape):
            return None
        if sign == "%":
            out.append("")
        else:
            out[-1] += sign
        at += 1
    return out


def in_order(text: Column, found: list[str]) -> Column:
    """Whether a text begins with the first of these, ends with the last, and has the others between them in
    order: the same as LIKE, where the first place of each is as good as any, without a backtracking search."""
    first, *between, last = found
    place, rest = F.lit(len(first) + 1), F.lit(True)
    for part in between:
        at = F.call_function("locate", F.lit(part), text, place)
        rest = rest & (at > 0)
        place = at + len(part)
    if last:
        rest = rest & text.endswith(last) & (F.length(text) - len(last) + 1 >= place)
    rest = F.when(text.isNotNull(), rest)  # locate from nowhere is 0, not null
    return text.startswith(first) & rest if first else rest


def column(p: object) -> Column:
    """The predicate as a Column; literals stay typed, timestamps keep their microseconds."""
    match p:
        case Compare(c, "<=>", v):
            return F.col(quoted(c)).eqNullSafe(F.lit(v))
        case Compare(c, sign, v) if sign in _SIGNS:
            return getattr(F.col(quoted(c)), f"__{_SIGNS[sign]}__")(F.lit(v))
        case In(c, values):
            return F.col(quoted(c)).isin(*values)
        case Null(c, wanted):
            return F.col(quoted(c)).isNull() if wanted else F.col(quoted(c)).isNotNull()
        case Text(c, how, v):
            return getattr(F.col(quoted(c)), _TEXTS[how][1])(v)
        case Like(c, pattern, escape):
            found = segments(pattern, escape)
            if found is not None and len(found) in (4, 5) and all(found[1:-1]):
                return in_order(F.col(quoted(c)), found)
            return F.like(F.col(quoted(c)), F.lit(pattern), F.lit(escape))
        case Both(a, b):
            return column(a) & column(b)
        case Either(a, b):
            return column(a) | column(b)
        case Not(a):
            return ~column(a)
    raise TypeError(f"not a predicate: {p!r}")


def literal(value: object) -> str:
    if value is None:
        return "NULL"
    if isinstance(value, bool):
        return str(value).lower()
    if isinstance(value, str):
        return "'" + value.replace("\\", "\\\\").replace("'", "''") + "'"
    if isinstance(value, dt.datetime):
        return f"'{value:%Y-%m-%d %H:%M:%S}.{value.microsecond:06d}'::TIMESTAMP(6)"
    if isinstance(value, dt.date):
        return f"'{value:%Y-%m-%d}'::DATE"
    if isinstance(value, (int, float, Decimal)):
        return str(value)
    raise TypeError(f"no literal for {type(value).__name__}")


def render(p: object, schema: StructType, keep_case: bool = False) -> str | None:
    """Text of a predicate, or None if it has none: an unknown column, ``<=>``, a pattern. Both
    sides of AND and OR must have a text."""
    name = lambda c: quote(c) if keep_case else c
    if isinstance(p, (Compare, In, Null, Text, Like)) and p.column not in schema.names:
        return None
    match p:
        case Compare(c, sign, v) if sign in _SIGNS:
            return f"{name(c)} {sign} {literal(v)}"
        case In(c, values):
            return f"( {name(c)} IN ( {' , '.join(map(literal, values))} ))"
        case Null(c, wanted):
            return f"( {name(c)} IS {'' if wanted else 'NOT '}NULL)"
        case Text(c, how, v):
            return f"{_TEXTS[how][0]}( {name(c)} , {literal(str(v))} )"
        case Both(a, b) | Either(a, b):
            left, right = render(a, schema, keep_case), render(b, schema, keep_case)
            word = "AND" if isinstance(p, Both) else "OR"
            return None if left is None or right is None else f"(( {left} ) {word} ( {right} ))"
        case Not(a):
            inner = render(a, schema, keep_case)
            return None if inner is None else f"(NOT ( {inner} ))"
    return None


def where(predicates: list, schema: StructType, keep_case: bool = False) -> str:
    """WHERE text of a conjunction; predicates without a text are left out of it."""
    found = [t for p in predicates if (t := render(p, schema, keep_case)) is not None]
    return "WHERE " + " AND ".join(found) if found else ""
