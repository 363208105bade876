"""Spans of code points in texts, as both scanners return them."""

from __future__ import annotations

from bisect import bisect_left, bisect_right
from collections.abc import Callable, Iterable
from itertools import accumulate

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewell.llm._common import arrow_map, pick

#: kind, start, end (code points, end exclusive), base (found by a plain pattern)
Span = tuple[str, int, int, bool]
TYPE = "array<struct<kind:string,start:int,end:int,base:boolean>>"
_ARROW = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32()), ("base", pa.bool_())]))


class Cover:
    """Ranges, asked in the logarithm of their number whether one of them holds or meets another."""

    def __init__(self, ranges: Iterable[tuple[int, int]]) -> None:
        ordered = sorted(ranges)
        self.starts = [a for a, _ in ordered]
        self.far = list(accumulate((b for _, b in ordered), max))  # the last end of those so far

    def holds(self, start: int, end: int) -> bool:
        at = bisect_right(self.starts, start)
        return at > 0 and self.far[at - 1] >= end

    def meets(self, start: int, end: int) -> bool:
        at = bisect_left(self.starts, end)
        return at > 0 and self.far[at - 1] > start


def maybe(texts: pa.Array, *patterns: str) -> list[bool]:
    """For each text whether one of the patterns (RE2) occurs; null counts as empty."""
    found = pa.array([False] * len(texts))
    for p in patterns:
        found = pc.or_(found, pc.fill_null(pc.match_substring_regex(texts, p), False))
    return found.to_pylist()


def span_array(found: list[list[Span]]) -> pa.Array:
    ends, flat = [0], []
    for spans in found:
        flat += spans
        ends.append(len(flat))
    cols = list(zip(*flat, strict=True)) if flat else [[], [], [], []]
    kinds = [pa.array(c, t.type) for c, t in zip(cols, _ARROW.value_type, strict=True)]
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.StructArray.from_arrays(kinds, fields=list(_ARROW.value_type)))


def find(df: DataFrame, scan: Callable[[pa.Array], list[list[Span]]], id_col: str, text_col: str) -> DataFrame:
    """(id, spans) of every row; scan takes the texts of a bounded slice."""
    rows = pick(df, id=id_col, text=text_col)

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([batch.column(0), span_array(scan(batch.column(1)))], names=["id", "spans"])

    schema = f"id {rows.schema['id'].dataType.simpleString()}, spans {TYPE}"
    return arrow_map(rows, run, schema).withColumnRenamed("id", id_col)


def count(kind: str) -> Column:
    """How many base spans of a kind a row has."""
    return F.size(F.filter("spans", lambda s: s["base"] & (s["kind"] == kind))).cast("long")


def joined(base_only: bool) -> Column:
    """kind:start:end of the spans in their order, comma-joined."""
    spans = F.filter("spans", lambda s: s["base"]) if base_only else F.col("spans")
    each = F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string")))
    return F.array_join(each, ",")
