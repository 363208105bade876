"""What the two nearest-neighbour classifiers share: labelled examples, terms and their statistics.

The classifiers learn from a bounded sample of labelled rows (``per_class`` of each label, a
documented parameter), chosen by a hash of the id. Every term of these examples counts, weighted by
how well it tells the labels apart. Document frequencies are counted over all documents. Scores never
see the label tables' or the documents' other columns.

Texts are counted a slice at a time: tokens become numbers in Arrow, and counts of (text, token), then
of (text, term), come from sorting numbers; no step is taken for each token in Python.
"""

from __future__ import annotations

import math
import re
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewell.llm._common import arrow_map, bound_batches, built, pick, relieve, slices, spread, stored

#: Examples of each label.
PER_CLASS = 1500
#: Least rate of a term, so that none is without weight.
LEAST_RATE = 0.01

#: A term that a text has this often or more is also a term of its own, as a cosine alone can't
#: tell one occurrence from many.
OFTEN = (2, 4, 8, 16)

#: Letters of the beginnings of words that stand for stems.
STEMS = (4,)
#: RE2 patterns of what parts words, and of tokens with runs of marks; and the latter for Python.
_NO_WORD, _MARKED = r"[^\p{L}\p{M}\p{N}_]+", r"[^\p{L}\p{M}\p{N}_\s]{2,}|\|"
_MARKS = re.compile(r"[^\w\s]{2,}|\|")


def shape_traits(text: str, n: int, distinct: int, twins: int) -> list[tuple[str, int]]:
    """Terms of a whole text of n tokens: its length, how varied its words are, repeated lines, and
    tokens that equal the one before."""
    lines = [x for x in text.split("\n") if x.strip()]
    again = len(lines) - len(set(lines))
    out = [(f"#length{int(math.log2(n + 1))}", 1), (f"#same{int(10 * (1 - distinct / max(n, 1)))}", 1)]
    if again:
        out.append((f"#lines{min(3, int(math.log2(again)))}", 1))
    if twins:
        out += [("#twins", twins), (f"#twins{int(10 * twins / n)}", 1)]
    return out


def often(term: str, times: int) -> str:
    return f"{times}*{term}"  # no term of a text has a star after a digit


class Rows:
    """Sparse rows one after the other: columns, values, and where each row starts."""

    def __init__(self, at: np.ndarray, values: np.ndarray, starts: np.ndarray) -> None:
        self.at, self.values, self.starts = at, values, starts

    def __len__(self) -> int:
        return len(self.starts) - 1

    def owners(self) -> np.ndarray:
        """The row of each value."""
        return np.repeat(np.arange(len(self), dtype=np.int64), np.diff(self.starts))

    def turned(self, n_columns: int) -> Rows:
        """The columns as rows."""
        order = np.argsort(self.at, kind="stable")
        return Rows(self.owners()[order].astype(np.int32), self.values[order], np.searchsorted(self.at[order], np.arange(n_columns + 1)))

    def places(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Where the values of these rows are, one row after the other, and how many each has."""
        return spread(self.starts[rows], self.starts[rows + 1] - self.starts[rows])

    def taken(self, rows: np.ndarray) -> Rows:
        places, n = self.places(rows)
        return Rows(self.at[places], self.values[places], np.concatenate([[0], np.cumsum(n)]))


def summed(key: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each distinct key in order, and the sum of its numbers."""
    if len(key) and key[-1] < 1 << 31 and key.max() < 1 << 31 and n.max() < 1 << 32:
        both = np.sort(key << 32 | n)  # numbers are sorted much faster than places
        key, n = both >> 32, both & 0xFFFFFFFF
    else:
        order = np.argsort(key, kind="stable")
        key, n = key[order], n[order]
    first = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]])) if len(key) else np.empty(0, np.int64)
    return key[first], np.add.reduceat(n, first) if len(first) else np.empty(0, np.int64)


class Tally:
    """The tokens of a slice of texts, how often each text has them, and the terms of each token:
    words in lower case, and their beginnings of four and five letters, which stand for stems. With
    ``shapes`` also runs of marks, whether the token is in capitals, and the traits of whole texts."""

    def __init__(self, texts: pa.Array, shapes: bool) -> None:
        texts = pc.fill_null(texts, "")
        split = pc.utf8_split_whitespace(texts)
        row = np.repeat(np.arange(len(texts), dtype=np.int64), split.value_lengths().to_numpy(zero_copy_only=False))
        coded = split.flatten().dictionary_encode()
        tokens, code = coded.dictionary, coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
        if (empty := pc.index(tokens, "").as_py()) >= 0:  # beside white space at the ends of a text
            full = code != empty
            row, code = row[full], code[full]
        n = max(len(tokens), 1)
        pair, self.n = np.unique(row * n + code, return_counts=True)
        self.row, self.token = np.divmod(pair, n)
        self.strings, self.edges = self._terms(tokens, shapes)
        self.traits: list[tuple[int, str, int]] = []
        if shapes:
            twin = row[1:][(code[1:] == code[:-1]) & (row[1:] == row[:-1])]
            per = [np.bincount(x, minlength=len(texts)).tolist() for x in (row, self.row, twin)]
            self.traits = [(i, *x) for i, (text, *of) in enumerate(zip(texts.to_pylist(), *per, strict=True)) for x in shape_traits(text, *of)]

    @staticmethod
    def _terms(tokens: pa.Array, shapes: bool) -> tuple[pa.Array, tuple[np.ndarray, np.ndarray]]:
        """Spelled terms, and (token, term) for each term of each token."""
        lists = pc.split_pattern(pc.replace_substring_regex(pc.utf8_lower(tokens), _NO_WORD, " "), " ")
        owner = np.repeat(np.arange(len(tokens)), lists.value_lengths().to_numpy(zero_copy_only=False))
        coded = lists.flatten().dictionary_encode()
        words, code = coded.dictionary, coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
        size = pc.utf8_length(words).to_numpy(zero_copy_only=False)
        real = size[code] > 0
        owner, code = owner[real], code[real]
        strings, edges, total = [words], [(owner, code)], len(words)
        for k in STEMS:
            long = size > k
            place = total + np.cumsum(long) - 1
            own = long[code]
            edges.append((owner[own], place[code[own]]))
            strings.append(pc.binary_join_element_wise("^", pc.utf8_slice_codeunits(words.filter(pa.array(long)), 0, k), ""))
            total += int(long.sum())
        if shapes:
            upper = np.flatnonzero(pc.and_(pc.utf8_is_upper(tokens), pc.greater(pc.utf8_length(tokens), 1)).to_numpy(zero_copy_only=False))
            marked = np.flatnonzero(pc.match_substring_regex(tokens, _MARKED).to_numpy(zero_copy_only=False))
            runs = [(int(i), f"#{m}") for i, t in zip(marked, tokens.take(pa.array(marked)).to_pylist(), strict=True) for m in _MARKS.findall(t)]
            edges += [(upper, np.full(len(upper), total)), (np.array([i for i, _ in runs], np.int64), total + 1 + np.arange(len(runs)))]
            strings.append(pa.array(["#capitals", *(m for _, m in runs)], pa.string()))
        return pa.concat_arrays(strings), tuple(np.concatenate(x).astype(np.int64) for x in zip(*edges, strict=True))

    def counts(self, number: np.ndarray, width: int, traits: list[tuple[int, int, int]]) -> tuple[np.ndarray, np.ndarray]:
        """(row * width + term, count), in order, with the number of each spelled term; -1: not wanted."""
        token, term = self.edges
        known = number[term] >= 0
        token, term = token[known], number[term[known]].astype(np.int64)
        order = np.argsort(token, kind="stable")
        term = term[order]
        starts = np.searchsorted(token[order], np.arange(int(self.token.max(initial=-1)) + 2))
        places, each = spread(starts[self.token], starts[self.token + 1] - starts[self.token])
        more = np.array(traits, np.int64).reshape(-1, 3)
        key = np.concatenate([np.repeat(self.row * width, each) + term[places], more[:, 0] * width + more[:, 1]])
        return summed(key, np.concatenate([np.repeat(self.n, each), more[:, 2]]))


def spelled(texts: pa.Array, shapes: bool) -> list[dict[str, int]]:
    """The terms of each text, which need not be known before, and their counts."""
    tally, own = Tally(texts, shapes), {}
    coded = tally.strings.dictionary_encode()
    names = coded.dictionary.to_pylist()
    own = {t: i for i, t in enumerate(names)}
    for _, t, _ in tally.traits:
        own.setdefault(t, len(own))
    width = max(len(own), 1)
    key, n = tally.counts(coded.indices.to_numpy(zero_copy_only=False), width, [(i, own[t], k) for i, t, k in tally.traits])
    out, names = [{} for _ in range(len(texts))], list(own)
    for k, c in zip(key.tolist(), n.tolist(), strict=True):
        row, term = divmod(k, width)
        out[row][names[term]] = c
    return [d | {often(t, m): 1 for t, c in d.items() for m in OFTEN if c >= m} for d in out]


class Counted:
    """Counts of known terms in slices of texts."""

    def __init__(self, terms: pa.Array, shapes: bool) -> None:
        self.shapes, self.width, self.terms = shapes, max(len(terms), 1), terms
        marks = np.flatnonzero(pc.starts_with(terms, "#").to_numpy(zero_copy_only=False))
        self.marks = dict(zip(terms.take(pa.array(marks)).to_pylist(), marks.tolist(), strict=True))
        starred = np.flatnonzero(pc.match_substring_regex(terms, r"^[0-9]+\*").to_numpy(zero_copy_only=False))
        parts = [t.partition("*") for t in terms.take(pa.array(starred)).to_pylist()]
        plain = pc.index_in(pa.array([p for _, _, p in parts], pa.string()), value_set=terms).to_numpy(zero_copy_only=False)
        self.times = np.full((len(OFTEN), self.width), -1, np.int32)
        self.times[[OFTEN.index(int(m)) for m, _, _ in parts], plain.astype(np.int64)] = starred

    def __call__(self, texts: pa.Array) -> Rows:
        """A row for each text, its terms in order; null counts as empty."""
        tally, width, marks = Tally(texts, self.shapes), self.width, self.marks
        number = pc.fill_null(pc.index_in(tally.strings, value_set=self.terms), -1).to_numpy(zero_copy_only=False)
        key, count = tally.counts(number, width, [(i, marks[t], k) for i, t, k in tally.traits if t in marks])
        term, keys, counts = key % width, [key], [count]
        for m, of in zip(OFTEN, self.times, strict=True):
            hit = np.flatnonzero((count >= m) & (of[term] >= 0))
            keys.append(key[hit] - term[hit] + of[term[hit]])
            counts.append(np.ones(len(hit), np.int64))
        key, count = summed(np.concatenate(keys), np.concatenate(counts))
        return Rows((key % width).astype(np.int32), count, np.searchsorted(key, np.arange(len(texts) + 1) * width))


def counter(terms: pa.Array, shapes: bool, key: str) -> Counted:
    """This worker's counter for these terms; the key tells one list of terms from another."""
    return built("labelled", key, lambda: Counted(terms, shapes))


@dataclass
class Examples:
    """Labelled texts in the order of their ids, with the counts of their terms."""

    ids: list
    labels: np.ndarray
    weights: np.ndarray  # rows of its label for each example of it
    counts: Rows
    terms: pa.Array


def examples(docs: DataFrame, labels: DataFrame, label: str, train: Callable[[Column], Column], shapes: bool, id_col: str, text_col: str, per_class: int) -> Examples:
    """At most per_class examples of each label from the rows that may be learned from, and all their
    terms in order. What comes to the driver is bounded by the sample. A null id or label is no
    example; of several labels of an id the largest counts, of several texts the first in order."""
    own = pick(labels, id=id_col, label=label).where("id is not null and label in (0, 1)").where(train(F.col("id")))
    own = own.groupBy("id").agg(F.max("label").cast("int").alias("label"))
    sizes = {r["label"]: r["count"] for r in own.groupBy("label").count().collect()}
    chosen = [own.where(F.col("label") == y).orderBy(F.xxhash64("id"), "id").limit(per_class) for y in (0, 1)]
    some = F.broadcast(chosen[0].union(chosen[1]))  # twice per_class rows at most
    rows = pick(docs, id=id_col, text=text_col).join(some, "id").groupBy("id", "label").agg(F.min(F.coalesce("text", F.lit(""))).alias("text"))
    kind = rows.schema["id"].dataType.simpleString()

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        found = spelled(batch.column(1), shapes)
        columns = [pa.array([list(c) for c in found], pa.list_(pa.string())), pa.array([list(c.values()) for c in found], pa.list_(pa.int32()))]
        return pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), *columns], names=["id", "label", "terms", "n"])

    table = stored(arrow_map(rows.select("id", "text", "label"), run, f"id {kind}, label int, terms array<string>, n array<int>")).toArrow()
    ids, lists = table["id"].to_pylist(), table["terms"].combine_chunks()
    coded = lists.flatten().dictionary_encode()
    names = coded.dictionary.to_pylist()
    order = sorted(range(len(names)), key=names.__getitem__)
    number = np.empty(len(order), np.int32)
    number[order] = np.arange(len(order))
    starts = np.concatenate([[0], np.cumsum(lists.value_lengths().to_numpy(zero_copy_only=False))]).astype(np.int64)
    counts = Rows(number[coded.indices.to_numpy(zero_copy_only=False)], table["n"].combine_chunks().flatten().to_numpy(zero_copy_only=False), starts)
    by_id = np.array(sorted(range(len(ids)), key=ids.__getitem__), np.int64)
    y = table["label"].to_numpy().astype(float)[by_id]
    weight = {k: n / min(n, per_class) for k, n in sizes.items()}
    return Examples([ids[i] for i in by_id], y, np.array([weight[int(k)] for k in y]), counts.taken(by_id), coded.dictionary.take(pa.array(order, pa.int64())))


def telling(found: Examples) -> np.ndarray:
    """Root of each term's chi-square of occurrence and label among the examples, LEAST_RATE at least:
    in plain TF-IDF cosines the many words that tell nothing outweigh those that do. Without examples
    of both labels all terms weigh the same."""
    n_terms, of = len(found.terms), found.labels[found.counts.owners()]
    n1 = float(found.labels.sum())
    n0 = len(found.ids) - n1
    if not n0 or not n1:
        return np.ones(n_terms)
    x, every = np.bincount(found.counts.at, of, n_terms), np.bincount(found.counts.at, minlength=n_terms)
    y = every - x
    wide = every * (n0 + n1 - every) * n0 * n1
    gap = x * (n0 - y) - y * (n1 - x)
    return np.sqrt(np.maximum(gap * gap * (n0 + n1) / np.where(wide > 0, wide, np.inf), LEAST_RATE))


def inverse_frequencies(docs: DataFrame, shapes: bool, terms: pa.Array, key: str, text_col: str) -> np.ndarray:
    """log(N / df) + 1 of each term, counted over all documents."""
    rows = pick(docs, text=text_col)
    bound_batches(rows.sparkSession)
    shared = rows.sparkSession.sparkContext.broadcast(terms)  # bounded by the sample of examples

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count, df = counter(shared.value, shapes, key), np.zeros(len(shared.value) + 1, np.int64)
        for batch in batches:
            for part in slices(batch):
                found = count(part.column(0)).at
                df[:-1] += np.bincount(found, minlength=len(df) - 1)
                df[-1] += len(part)
        at = np.flatnonzero(df)
        relieve()
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int32()), pa.array(df[at])], names=["term", "df"])

    total = rows.mapInArrow(run, "term int, df bigint").groupBy("term").agg(F.sum("df").alias("df")).toArrow()
    df = np.ones(len(terms) + 1)
    df[total.column("term").to_numpy()] = total.column("df").to_numpy()
    return np.log(max(df[-1], 1.0) / np.minimum(df[:-1], df[-1])) + 1


def weighted(counts: Rows, idf: np.ndarray) -> Rows:
    """The TF-IDF weights of each row's terms, of length 1 together, in single precision."""
    w = (1 + np.log(counts.values)) * idf[counts.at]
    own = counts.owners()
    return Rows(counts.at, (w / np.sqrt(np.bincount(own, w * w, len(counts)))[own]).astype(np.float32), counts.starts)


def votes(similarity: np.ndarray, labels: np.ndarray, rows: np.ndarray, prior: float, power: float, smoothing: float) -> np.ndarray:
    """Share of label 1 among neighbours (the last axis), each weighted by the power of its similarity and
    by the rows that it stands for; the prior has a little weight of its own."""
    w = np.maximum(similarity, 0) ** power * rows
    return ((w * labels).sum(-1) + smoothing * prior) / (w.sum(-1) + smoothing)


def platt(raw: Iterable[float], labels: np.ndarray, rows: np.ndarray) -> tuple[float, float]:
    """Slope and intercept of the logistic curve that fits votes to labels best, with a slope of 1
    or more, so that the order of scores is kept and certain votes stay certain."""
    x = logit(np.fromiter(raw, float))
    a, b = 1.0, 0.0
    if len(x) and 0 < labels.sum() < len(labels):
        w = rows / rows.sum() * len(rows)
        for _ in range(50):
            p = 1 / (1 + np.exp(-(a * x + b)))
            g, h = w * (p - labels), w * p * (1 - p)
            grad = np.array([(g * x).sum() + 0.1 * (a - 1), g.sum() + 0.1 * b])
            hess = np.array([[(h * x * x).sum() + 0.1, (h * x).sum()], [(h * x).sum(), h.sum() + 0.1]])
            step = np.linalg.solve(hess, grad)
            a, b = a - float(np.clip(step[0], -1, 1)), b - float(np.clip(step[1], -1, 1))
            if np.abs(step).max() < 1e-9:
                break
    return max(a, 1.0), b


def logit(p):
    p = np.clip(p, 1e-6, 1 - 1e-6)
    return np.log(p / (1 - p))


def calibrated(raw: np.ndarray, curve: tuple[float, float]) -> np.ndarray:
    return 1 / (1 + np.exp(-(curve[0] * logit(raw) + curve[1])))
