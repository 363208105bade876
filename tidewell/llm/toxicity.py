"""Toxicity by the nearest labelled examples.

Texts are TF-IDF vectors of all terms of the examples (words and their beginnings), each weighted by
how well it tells the labels apart. The examples' vectors are an inverted index. Lists of frequent
terms are kept in full as columns of a table, and one product adds them to all cosines of a block of
texts. The other lists are cut into blocks of examples with the largest weight of each: these maxima
bound what a block of examples can still gain, and only blocks that may hold one of a text's nearest
examples are read. Candidates at the cut are multiplied out again in double precision, so the cosines of
the nearest examples are exact. They vote, weighted by similarity; a logistic curve, fitted to votes on
the examples without themselves, makes the votes probabilities; the nearest examples are the evidence.

Defined results: a null text counts as empty; a text without any of the terms gets the share of
label 1 among such examples, or the prior if there are none, or 0 without any labels. Of examples
at equal similarity the smaller id comes first. Rows are independent, so repeated rows and null ids
come out as they went in. Extra columns are not carried by ``score``; ``drop_toxic`` carries all.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame

from tidewell.llm import labelled as L
from tidewell.llm._common import arrow_map, map_rows, pick, spread

NEIGHBOURS = 10
#: Texts of one product, examples of a block of a list, and the length from which a list is kept in full.
TEXTS, BLOCK, LONG = 128, 64, 128
#: Examples that texts and examples are put in order by.
PIVOTS = 16
#: Votes: power of the similarity, and the weight of the prior.
POWER, SMOOTHING = 4, 0.05
#: What single precision may lose of a cosine.
SLACK = 1e-5


class Index:
    """Inverted index of the examples' vectors with the largest weight of each block of a list."""

    def __init__(self, rows: L.Rows, n_terms: int) -> None:
        self.size, self.n_terms = len(rows), n_terms
        length = np.bincount(rows.at, minlength=n_terms)
        long = np.flatnonzero(length >= LONG)
        self.column = np.full(n_terms, -1, np.int32)
        self.column[long] = np.arange(len(long))
        # Examples that are alike stand together, so that blocks have few terms each.
        table = self._table(rows)
        self.pivots = _far_apart(table, PIVOTS)
        self.number = np.argsort((table @ self.pivots).argmax(axis=1), kind="stable") if len(long) and self.size else np.arange(self.size)
        self.full = np.ascontiguousarray(table[self.number].T)
        self.rows = rows.taken(self.number)

        lists = self.rows.turned(n_terms)
        short = np.flatnonzero((length < LONG) & (length > 0))
        places, n = lists.places(short)
        term, self.example, self.weight = np.repeat(short, n), lists.at[places], lists.values[places].astype(np.float32)
        self.n_blocks = max(-(-self.size // BLOCK), 1)
        block = term * self.n_blocks + self.example // BLOCK
        first = np.flatnonzero(np.concatenate([[True], block[1:] != block[:-1]])) if len(block) else np.empty(0, np.int64)
        most = np.maximum.reduceat(self.weight, first) if len(first) else np.empty(0, np.float32)
        self.ends = np.append(first, len(block))
        #: For each term its blocks, with the largest weight in each.
        self.blocks = L.Rows((block[first] % self.n_blocks).astype(np.int32), most, np.searchsorted(term[first], np.arange(n_terms + 1)))

    def _table(self, texts: L.Rows) -> np.ndarray:
        """The weights of the long lists' terms, a row for each text."""
        column, own = self.column[texts.at], texts.owners()
        head = column >= 0
        out = np.zeros((len(texts), int(self.column.max(initial=-1)) + 1), np.float32)
        out[own[head], column[head]] = texts.values[head]
        return out

    def _cosines(self, texts: L.Rows, table: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Of all examples that can be among the k nearest of each text; too small for some others. Also
        the part that comes from the short lists, in double precision."""
        n, used = len(texts), np.flatnonzero(table.any(axis=0))
        out = table[:, used] @ self.full[used] if len(used) else np.zeros((n, self.size), np.float32)
        # What each block of examples can still gain from the other lists.
        tail = self.column[texts.at] < 0
        own, at, w = texts.owners()[tail], texts.at[tail], texts.values[tail]
        places, many = self.blocks.places(at)
        text, weight = np.repeat(own, many), np.repeat(w, many)
        key = text * self.n_blocks + self.blocks.at[places]
        gain = np.bincount(key, weight * self.blocks.values[places], n * self.n_blocks).reshape(n, -1)
        if self.size > k:
            least = np.partition(out, self.size - k, axis=1)[:, self.size - k, None]
            best = np.maximum.reduceat(out, np.arange(0, self.size, BLOCK), axis=1)
            look = np.flatnonzero((best + gain >= least - SLACK).reshape(-1)[key])
            places, text, weight = places[look], text[look], weight[look]
        entry, many = spread(self.ends[places], self.ends[places + 1] - self.ends[places])
        key = np.repeat(text * self.size, many) + self.example[entry]
        more = np.bincount(key, np.repeat(weight, many) * self.weight[entry], n * self.size).reshape(n, -1)
        out += more
        return out, more

    def nearest(self, texts: L.Rows, k: int) -> tuple[np.ndarray, np.ndarray]:
        """The k nearest examples of each text by cosine, then number; -1 and 0 where fewer share a term."""
        near, sims = np.full((len(texts), k), -1, np.int64), np.zeros((len(texts), k))
        if not self.size or not self.n_terms:
            return near, sims
        for start in range(0, len(texts), 8 * TEXTS):
            chunk = texts.taken(np.arange(start, min(start + 8 * TEXTS, len(texts))))
            table = self._table(chunk)
            order = np.argsort((table @ self.pivots).argmax(axis=1), kind="stable") if table.shape[1] else np.arange(len(chunk))
            for some in range(0, len(order), TEXTS):
                own = order[some : some + TEXTS]
                near[start + own], sims[start + own] = self._nearest(chunk.taken(own), table[own], k)
        return near, sims

    def _nearest(self, part: L.Rows, table: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        near, sims = np.full((len(part), k), -1, np.int64), np.zeros((len(part), k))
        rough, short = self._cosines(part, table, k)
        cut = np.partition(rough, self.size - k, axis=1)[:, self.size - k] if self.size > k else np.zeros(len(part))
        text, at = np.nonzero((rough >= cut[:, None] - SLACK) & (rough > 0))
        bounds = np.searchsorted(text, np.arange(len(part) + 1)).tolist()
        for i in range(len(part)):
            some = at[bounds[i] : bounds[i + 1]]
            columns = np.flatnonzero(table[i])
            s = table[i, columns].astype(float) @ self.full[columns[:, None], some].astype(float) + short[i, some]
            s, some = np.round(s, 12), self.number[some]
            top = np.lexsort((some, -s))[:k]
            near[i, : len(top)], sims[i, : len(top)] = some[top], s[top]
        return near, sims


def _far_apart(table: np.ndarray, n: int) -> np.ndarray:
    """n rows, as columns: each is the one that is least like those before it."""
    chosen, closest = [], np.full(len(table), -1.0)
    for _ in range(min(n, len(table))):
        chosen.append(int(closest.argmin()))
        closest = np.maximum(closest, table @ table[chosen[-1]])
    return np.ascontiguousarray(table[chosen].T)


class Model:
    """Terms, their weights, the index, and the curve that calibrates votes."""

    def __init__(self, found: L.Examples, idf: np.ndarray, neighbours: int, key: str) -> None:
        self.terms, self.idf, self.k, self.key = found.terms, idf * L.telling(found), neighbours, key
        self.ids, self.labels, self.rows = found.ids, found.labels, found.weights
        vectors = L.weighted(found.counts, self.idf)
        self.index = Index(vectors, len(found.terms))
        total = self.rows.sum()
        self.prior = float((self.labels * self.rows).sum() / total) if total else 0.0
        bare = np.diff(vectors.starts) == 0
        self.without = float((self.labels * self.rows)[bare].sum() / self.rows[bare].sum()) if bare.any() else self.prior
        near, sims = self.index.nearest(vectors, self.k + 1)
        own = near == np.arange(len(near))[:, None]  # each example without itself, which may be behind its copies
        own[~own.any(axis=1), -1] = True
        near, sims = (x[~own].reshape(len(near), self.k) for x in (near, sims))
        self.curve = L.platt(self._vote(near, sims), self.labels, self.rows)

    def _vote(self, near: np.ndarray, sims: np.ndarray) -> np.ndarray:
        if not len(self.ids):
            return np.full(len(near), self.without)
        return np.where((near >= 0).any(axis=1), L.votes(sims, self.labels[near], self.rows[near], self.prior, POWER, SMOOTHING), self.without)

    def score(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Scores, and the nearest examples of each text with their similarities (-1: no more)."""
        vectors = L.weighted(L.counter(self.terms, False, self.key)(texts), self.idf)
        near, sims = self.index.nearest(vectors, self.k)
        bare = np.diff(vectors.starts) == 0
        return np.where(bare, self.without, L.calibrated(self._vote(near, sims), self.curve)), near, sims


def fit(
    docs: DataFrame,
    labels: DataFrame,
    train: Callable[[Column], Column],
    label: str = "toxic",
    id_col: str = "doc_id",
    text_col: str = "text",
    per_class: int = L.PER_CLASS,
    neighbours: int = NEIGHBOURS,
) -> Model:
    """Fit on per_class examples of each label at most; term frequencies come from all documents."""
    found, key = L.examples(docs, labels, label, train, False, id_col, text_col, per_class), uuid.uuid4().hex
    return Model(found, L.inverse_frequencies(docs, False, found.terms, key, text_col), neighbours, key)


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, score, evidence): evidence holds id, similarity and label of the nearest examples."""
    rows = pick(docs, id=id_col, text=text_col)
    shared = rows.sparkSession.sparkContext.broadcast(model)  # bounded by the terms of the examples
    kind = rows.schema["id"].dataType.simpleString()
    id_type = rows.schema["id"].dataType

    from pyspark.sql.pandas.types import to_arrow_type

    ids_type = to_arrow_type(id_type)

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        own = shared.value
        scores, near, sims = own.score(batch.column(1))
        held = near >= 0
        ends = np.concatenate([[0], np.cumsum(held.sum(axis=1))])
        at = near[held]
        columns = [pa.array(own.ids, ids_type).take(pa.array(at)), pa.array(sims[held]), pa.array(own.labels[at].astype(np.int32) if len(at) else [], pa.int32())]
        evidence = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.StructArray.from_arrays(columns, names=["id", "similarity", "label"]))
        return pa.RecordBatch.from_arrays([batch.column(0), pa.array(scores, pa.float64()), evidence], names=["id", "score", "evidence"])

    schema = f"id {kind}, score double, evidence array<struct<id:{kind},similarity:double,label:int>>"
    return arrow_map(rows, run, schema).withColumnRenamed("id", id_col)


def drop_toxic(docs: DataFrame, model: Model, text_col: str = "text", limit: float = 0.5) -> DataFrame:
    """The rows whose score is below the limit, with all their columns."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(texts: pa.Array) -> tuple[pa.Array, pa.Array]:
        return texts, pa.array(shared.value.score(texts)[0] < limit)

    return map_rows(docs, text_col, run)
