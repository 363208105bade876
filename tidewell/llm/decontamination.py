"""Benchmark decontamination by a generalised suffix automaton.

The automaton of the normalised benchmark items is small and goes to every task; training words
stream through it while the length of the longest match that ends at each word is tracked. A match
of ``window`` words or more covers its words; an item shorter than the window counts as a whole.

Words are ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` after A-Z are lower-cased: digits, letters a-z and
everything that is not ASCII.

Defined results: null and empty texts have no words and are clean; items without words are ignored;
items of the same text all count; an item id that is null is ignored; an empty benchmark leaves all
documents clean. Rows are independent of each other. Extra columns are not carried by ``scan``;
``clean`` carries all columns as they are. Whole texts are scanned.

The benchmark is a stated query set. It is cut into blocks of bounded size; what travels to the tasks
is the texts of a block, and a worker builds the block's automaton and holds no other. One block takes
one pass over the documents and no shuffle. Of more, each takes a pass of its own; hits, not texts, are
then brought together by number of row, so the table of rows is stored once for it.
"""

from __future__ import annotations

import re
import uuid
from array import array

import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewell.llm._common import arrow_map, built, column_index, map_rows, pick, stored

WINDOW = 10
#: Words of one block of items; an automaton has at most twice as many states.
BLOCK_WORDS = 200_000

_TABLE = bytes(b + 32 if 0x41 <= b <= 0x5A else b if 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A or b >= 0x80 else 0x20 for b in range(256))
_WORD = re.compile("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")


def words(text: str | None) -> list[bytes]:
    """Normalised words. No byte of a character beyond ASCII is an ASCII byte, so bytes will do."""
    return text.encode().translate(_TABLE).split() if text else []


class Automaton:
    """Suffix automaton of several word sequences, with the items of each state."""

    def __init__(self, items: list[tuple[str, list[bytes]]], window: int) -> None:
        self.window = window
        self.next: list[dict[bytes, int]] = [{}]
        self.link, self.length = array("i", [-1]), array("i", [0])
        owners: list[set[int]] = [set()]
        self.names: list[str] = []
        for name, sequence in items:
            at = 0
            self.names.append(name)
            for w in sequence:
                at = self._extend(at, w)
        # Once all states are there: an item has the states of its prefixes and all on their suffix links.
        for own, (_, sequence) in enumerate(items):
            at = 0
            for w in sequence:
                at = self.next[at][w]
                s = at
                while s > 0:
                    while len(owners) <= s:
                        owners.append(set())
                    if own in owners[s]:
                        break
                    owners[s].add(own)
                    s = self.link[s]
        owners += [set() for _ in range(len(self.next) - len(owners))]
        self.owners = [frozenset(x) for x in owners]
        self._short_items(items)

    def _extend(self, last: int, word: bytes) -> int:
        nxt, link, length = self.next, self.link, self.length
        if word in nxt[last]:
            to = nxt[last][word]
            return to if length[to] == length[last] + 1 else self._clone(last, word, to)
        new = len(nxt)
        nxt.append({})
        length.append(length[last] + 1)
        link.append(0)
        while last >= 0 and word not in nxt[last]:
            nxt[last][word] = new
            last = link[last]
        if last >= 0:
            to = nxt[last][word]
            link[new] = to if length[to] == length[last] + 1 else self._clone(last, word, to)
        return new

    def _clone(self, last: int, word: bytes, to: int) -> int:
        nxt, link, length = self.next, self.link, self.length
        copy = len(nxt)
        nxt.append(dict(nxt[to]))
        length.append(length[last] + 1)
        link.append(link[to])
        link[to] = copy
        while last >= 0 and nxt[last].get(word) == to:
            nxt[last][word] = copy
            last = link[last]
        return copy

    def _short_items(self, items: list[tuple[str, list[bytes]]]) -> None:
        """For each state, the short items that are a suffix of its longest string: (length, item)."""
        at_state: dict[int, list[tuple[int, int]]] = {}
        for i, (_, sequence) in enumerate(items):
            if len(sequence) < self.window:
                at = 0
                for w in sequence:
                    at = self.next[at][w]
                at_state.setdefault(at, []).append((len(sequence), i))
        self.short: dict[int, list[tuple[int, int]]] = {}
        for s in sorted(range(1, len(self.next)), key=self.length.__getitem__) if at_state else ():
            found = self.short.get(self.link[s], []) + at_state.get(s, [])
            if found:
                self.short[s] = found

    def scan(self, text: list[bytes]) -> tuple[list[tuple[int, int]], set[int]]:
        """Ranges of words covered by occurring windows, merged, and the items that have them."""
        nxt, link, length, window, short = self.next, self.link, self.length, self.window, self.short
        root, found, items = nxt[0], [], set()
        state = matched = 0
        for i, w in enumerate(text):
            if state:
                step = nxt[state].get(w)
                while step is None and state:
                    state = link[state]
                    matched = length[state]
                    step = nxt[state].get(w)
            else:
                step = root.get(w)
            if step is None:
                continue
            state = step
            matched += 1
            if matched >= window:
                found.append((i + 1 - matched, i + 1))
                at = state
                while length[link[at]] >= window:  # to the state of the last window's words
                    at = link[at]
                items |= self.owners[at]
            if state in short:
                for size, item in short[state]:
                    if size <= matched:
                        found.append((i + 1 - size, i + 1))
                        items.add(item)
        return merged(found), items


def merged(ranges: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for start, end in sorted(ranges):
        if out and start <= out[-1][1]:
            out[-1] = (out[-1][0], max(end, out[-1][1]))
        else:
            out.append((start, end))
    return out


def blocks(items: DataFrame, id_col: str, text_col: str, block_words: int) -> list[Broadcast]:
    """The items in blocks of bounded size. Rows come to the driver one partition after another, and
    what it holds is one block."""
    out, block, size = [], [], 0
    rows = pick(items, id=id_col, text=text_col).where("id is not null and text is not null")
    share = lambda: out.append(items.sparkSession.sparkContext.broadcast((uuid.uuid4().hex, block)))
    for row in rows.toLocalIterator():
        if n := len(words(row["text"])):
            block.append((str(row["id"]), row["text"]))
            size += n
            if size >= block_words:
                share()
                block, size = [], 0
    if block or not out:
        share()
    return out


def automaton(block: Broadcast, window: int) -> Automaton:
    """The automaton of a block; this worker builds it once, and keeps one at a time."""
    key, own = block.value
    return built("decontamination", key, lambda: Automaton([(name, words(text)) for name, text in own], window))


RANGES = "array<struct<start:int,end:int>>"
_RANGES = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))


def _scanned(rows: DataFrame, block: Broadcast, window: int) -> DataFrame:
    """(id, n_words, n_hit, hits, item_ids) of rows (id, text) against one block."""

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        own = automaton(block, window)
        n_words, n_hit, hits, ids = [], [], [], []
        for text in batch.column(1).to_pylist():
            sequence = words(text)
            ranges, found = own.scan(sequence)
            n_words.append(len(sequence))
            n_hit.append(sum(b - a for a, b in ranges))
            hits.append([{"start": a, "end": b} for a, b in ranges])
            ids.append(sorted({own.names[i] for i in found}))
        columns = [pa.array(n_words, pa.int64()), pa.array(n_hit, pa.int64()), pa.array(hits, _RANGES), pa.array(ids, pa.list_(pa.string()))]
        return pa.RecordBatch.from_arrays([batch.column(0), *columns], names=["id", "n_words", "n_hit", "hits", "item_ids"])

    kind = rows.schema["id"].dataType.simpleString()
    return arrow_map(rows, run, f"id {kind}, n_words bigint, n_hit bigint, hits {RANGES}, item_ids array<string>")


def _merged(lists: Column) -> Column:
    @F.arrow_udf(RANGES)
    def run(values: pa.Array) -> pa.Array:
        both = [merged([(r["start"], r["end"]) for r in x]) for x in values.to_pylist()]
        return pa.array([[{"start": a, "end": b} for a, b in x] for x in both], _RANGES)

    return run(lists)


def _by_row(numbered: DataFrame, parts: list[Broadcast], window: int) -> DataFrame:
    """As _scanned, over all blocks: a pass over the rows (id, text) for each block, where a task holds
    the automaton of its block only. Ids are numbers of rows here, and only hits are shuffled."""
    own = [_scanned(numbered, b, window) for b in parts]
    found = own[0]
    for other in own[1:]:
        found = found.union(other.where("n_hit > 0"))
    found = found.groupBy("id").agg(F.max("n_words").alias("n_words"), F.flatten(F.collect_list("hits")).alias("hits"), F.array_sort(F.array_distinct(F.flatten(F.collect_list("item_ids")))).alias("item_ids"))
    found = found.withColumn("hits", _merged(F.col("hits")))
    return found.withColumn("n_hit", F.aggregate("hits", F.lit(0).cast("long"), lambda n, r: n + (r["end"] - r["start"])))


def scan(
    docs: DataFrame,
    items: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_id_col: str = "item_id",
    item_text_col: str = "text",
    window: int = WINDOW,
    block_words: int = BLOCK_WORDS,
) -> DataFrame:
    """(id, n_words, n_hit, hits, item_ids) of every row: hits are ranges of words, end exclusive,
    and item_ids the items with occurring windows, sorted as strings."""
    rows, parts = pick(docs, id=id_col, text=text_col), blocks(items, item_id_col, item_text_col, block_words)
    if len(parts) == 1:
        return _scanned(rows, parts[0], window).withColumnRenamed("id", id_col)
    numbered = stored(rows.withColumn("row", F.monotonically_increasing_id()))
    found = _by_row(numbered.select(F.col("row").alias("id"), "text"), parts, window).withColumnRenamed("id", "row")
    return numbered.select("row", "id").join(found, "row").select(F.col("id").alias(id_col), "n_words", "n_hit", "hits", "item_ids")


def without(text: str, ranges: list[tuple[int, int]]) -> str:
    """The text without the given ranges of words, and without what stands within a range."""
    ends = [m.span() for m in _WORD.finditer(text)]
    parts, at = [], 0
    for start, end in ranges:
        parts.append(text[at : ends[start][0]])
        at = ends[end - 1][1]
    return "".join([*parts, text[at:]])


def clean(
    docs: DataFrame,
    items: DataFrame,
    text_col: str = "text",
    item_id_col: str = "item_id",
    item_text_col: str = "text",
    window: int = WINDOW,
    max_coverage: float = 0.5,
    block_words: int = BLOCK_WORDS,
) -> DataFrame:
    """The same rows and columns with covered spans cut out of the text; a row goes if more than
    ``max_coverage`` of its words are covered."""
    parts = blocks(items, item_id_col, item_text_col, block_words)
    if len(parts) == 1:

        def run(texts: pa.Array) -> tuple[pa.Array, pa.Array]:
            own, out, keep = automaton(parts[0], window), [], []
            for text in texts.to_pylist():
                sequence = words(text)
                ranges = own.scan(sequence)[0]
                out.append(without(text, ranges) if ranges else text)
                keep.append(sum(b - a for a, b in ranges) <= max_coverage * len(sequence))
            return pa.array(out, pa.string()), pa.array(keep, pa.bool_())

        return map_rows(docs, text_col, run)

    names, at = [f"_c{i}" for i in range(len(docs.columns))], f"_c{column_index(docs, text_col)}"
    numbered = stored(docs.toDF(*names).withColumn("_row", F.monotonically_increasing_id()))
    found = _by_row(numbered.select(F.col("_row").alias("id"), F.col(at).alias("text")), parts, window)
    hit = found.where("n_hit > 0").select(F.col("id").alias("_row"), "hits", (F.col("n_hit") <= max_coverage * F.col("n_words")).alias("_kept"))

    @F.arrow_udf("string")
    def cut(texts: pa.Array, hits: pa.Array) -> pa.Array:
        return pa.array([without(t, [(r["start"], r["end"]) for r in h]) for t, h in zip(texts.to_pylist(), hits.to_pylist(), strict=True)], pa.string())

    whole = numbered.join(hit.select("_row"), "_row", "left_anti").select(*names)
    shorter = numbered.join(hit.where("_kept"), "_row").withColumn(at, cut(at, "hits")).select(*names)
    return whole.union(shorter).toDF(*docs.columns)


def item_list(item_ids: Column | str) -> Column:
    return F.array_join(item_ids, ",")
