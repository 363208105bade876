"""Quality by nearest-neighbour voting among labelled latent-semantic vectors.

The examples' TF-IDF rows, over all their terms, each weighted by how well it tells the labels apart,
are reduced by a truncated singular value decomposition, taken from the products of the rows. The
reduced, normalised vectors go to every task; each document is projected the same way, its cosines
with all examples are exact products of blocks, and the nearest vote with their labels, weighted by
similarity.

Defined results: a null text counts as empty; a text whose vector is zero gets the prior, which is
0 without any labels. Cosines are rounded to DIGITS places; of examples at equal ones those of the
smallest ids count. Rows are independent, so repeated rows and null ids come out as they went in;
extra columns are not carried.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame

from tidewell.llm import labelled as L
from tidewell.llm._common import arrow_map, pick

DIMENSIONS, NEIGHBOURS = 64, 10
POWER, SMOOTHING = 4, 0.05
#: Documents of one block of products, and terms of one block of the fit.
BLOCK, PART = 256, 512
#: Terms of no more examples than this are taken pair by pair in the fit.
FEW = 96
#: Places of a cosine that count.
DIGITS = 5
#: Vectors beside those asked for, and rounds, of the iteration that finds the axes.
BESIDE, ROUNDS = 32, 60


class Model:
    """The projection, the examples' reduced vectors and their labels."""

    def __init__(self, found: L.Examples, idf: np.ndarray, dimensions: int, neighbours: int, key: str) -> None:
        self.terms, self.idf, self.key = found.terms, (idf * L.telling(found)), key
        self.labels, self.rows, self.k = found.labels, found.weights, min(neighbours, len(found.ids))
        self.prior = float((self.labels * self.rows).sum() / self.rows.sum()) if len(self.rows) else 0.0
        table = L.weighted(found.counts, self.idf)
        self.axes = principal_axes(table, len(self.terms), dimensions)
        self.vectors = self._reduced(table)

    def _reduced(self, table: L.Rows) -> np.ndarray:
        low = combined(table, self.axes)
        return low / np.maximum(np.linalg.norm(low, axis=1, keepdims=True), 1e-9)

    def score(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Scores and the numbers of the nearest examples, in order, of each text."""
        low = self._reduced(L.weighted(L.counter(self.terms, True, self.key)(texts), self.idf))
        scores, near = np.full(len(low), self.prior), np.full((len(low), self.k), -1)
        known = np.flatnonzero(low.any(axis=1)) if self.k else ()
        for start in range(0, len(known), BLOCK):
            own = known[start : start + BLOCK]
            # As whole numbers, so that a smaller number of the example can break ties.
            cosines = np.round((low[own] @ self.vectors.T).astype(float) * 10**DIGITS).astype(np.int64)
            n = cosines.shape[1]
            order = cosines * n + (n - 1 - np.arange(n))
            top = np.argpartition(order, n - self.k, axis=1)[:, n - self.k :]
            top = np.take_along_axis(top, np.argsort(-np.take_along_axis(order, top, 1), axis=1), 1)
            similarity = np.take_along_axis(cosines, top, 1) / 10**DIGITS
            scores[own], near[own] = L.votes(similarity, self.labels[top], self.rows[top], self.prior, POWER, SMOOTHING), top
        return scores, near


def combined(rows: L.Rows, vectors: np.ndarray) -> np.ndarray:
    """For each row the sum of the vectors of its columns, each times its value."""
    out = np.zeros((len(rows), vectors.shape[1]), np.float32)
    full = np.flatnonzero(np.diff(rows.starts))
    parts = max(1, int(rows.starts[-1]) >> 17)
    for some in np.array_split(full, min(parts, len(full))) if len(full) else ():
        part = rows.taken(some)
        out[some] = np.add.reduceat(vectors[part.at] * part.values[:, None].astype(np.float32), part.starts[:-1], axis=0)
    return out


def principal_axes(table: L.Rows, n_terms: int, dimensions: int) -> np.ndarray:
    """The right singular vectors of the largest singular values, a column each, by subspace iteration
    on the rows' products. These are summed over blocks of terms, so no table of all examples and
    terms is held."""
    size = len(table)
    if not size or not n_terms:
        return np.zeros((n_terms, 1), np.float32)
    lists = table.turned(n_terms)
    products = np.zeros((size, size))
    # A term of few examples adds to few products; the others are taken in dense blocks.
    many = np.diff(lists.starts)
    flat = products.reshape(-1)
    for n in range(1, FEW + 1):
        of = np.flatnonzero(many == n)
        for some in np.array_split(of, max(1, len(of) * n * n >> 20)):
            at, w = (x[lists.places(some)[0]].reshape(-1, n).astype(t) for x, t in ((lists.at, np.int64), (lists.values, float)))
            np.add.at(flat, (at[:, :, None] * size + at[:, None, :]).reshape(-1), (w[:, :, None] * w[:, None, :]).reshape(-1))
    common = np.flatnonzero(many > FEW)
    for start in range(0, len(common), PART):
        places, n = lists.places(common[start : start + PART])
        block = np.zeros((size, len(n)), np.float32)
        block[lists.at[places], np.repeat(np.arange(len(n)), n)] = lists.values[places]
        products += block @ block.T
    width = min(size, dimensions + BESIDE)
    left = np.linalg.qr(np.cos(np.outer(np.arange(1, size + 1), np.arange(1, width + 1)) * 1.6180339887) + np.eye(size, width))[0]
    values = np.zeros(width)
    for _ in range(ROUNDS):
        left, was = np.linalg.qr(products @ left)[0], values
        values, turn = np.linalg.eigh(left.T @ (products @ left))
        left = left @ turn
        if np.abs(values - was).max() <= 1e-9 * max(values.max(), 1e-300):
            break
    top = np.argsort(-values, kind="stable")[:dimensions]
    top = top[values[top] > 1e-10 * max(values.max(), 1e-300)]
    axes = combined(lists, (left[:, top] / np.sqrt(values[top])).astype(np.float32))
    for own in axes.T:  # of the two signs, the one that makes the largest part positive
        own *= 1 if own.max() >= -own.min() else -1
    return axes


def fit(
    docs: DataFrame,
    labels: DataFrame,
    train: Callable[[Column], Column],
    label: str = "quality",
    id_col: str = "doc_id",
    text_col: str = "text",
    per_class: int = L.PER_CLASS,
    dimensions: int = DIMENSIONS,
    neighbours: int = NEIGHBOURS,
) -> Model:
    """Fit on per_class examples of each label at most; term frequencies come from all documents."""
    found, key = L.examples(docs, labels, label, train, True, id_col, text_col, per_class), uuid.uuid4().hex
    return Model(found, L.inverse_frequencies(docs, True, found.terms, key, text_col), dimensions, neighbours, key)


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, score) of every row."""
    rows = pick(docs, id=id_col, text=text_col)
    shared = rows.sparkSession.sparkContext.broadcast(model)  # bounded: terms and examples times dimensions

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        scores, _ = shared.value.score(batch.column(1))
        return pa.RecordBatch.from_arrays([batch.column(0), pa.array(scores, pa.float64())], names=["id", "score"])

    return arrow_map(rows, run, f"id {rows.schema['id'].dataType.simpleString()}, score double").withColumnRenamed("id", id_col)
