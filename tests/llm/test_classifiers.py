import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from tidewell.llm import labelled as L
from tidewell.llm import quality_classifier, queries_classifiers, toxicity

BAD, STEM = ("vile", "scorn", "rotten"), "grumb"


def make(seed, n):
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("abcdefghijkl") for _ in range(rng.randrange(3, 8)))
    docs, labels = [], []
    for i in range(n):
        words, toxic, poor = [word() for _ in range(rng.randrange(30, 120))], rng.random() < 0.25, rng.random() < 0.25
        if toxic:
            for _ in range(5):
                words.insert(rng.randrange(len(words)), rng.choice(BAD) if i % 2 else STEM + word())
        if poor:
            words = [w.upper() + "!!" for w in words] if i % 2 else words[:5] * 12
        docs.append((i, " ".join(words), "en"))
        labels.append((i, int(not poor), int(toxic)))
    docs += [(10_001, None, "en"), (10_002, "", "en"), (None, "vile scorn", "en"), (10_003, "word " * 30_000, "en"), (5, docs[5][1], "en")]
    labels += [(10_002, None, None), (None, 1, 1), (99_999, 1, 1), (7, 1, 0), (7, 1, 0)]
    return docs, labels


@pytest.fixture(scope="module")
def tables(spark):
    docs, labels = make(1, 900)
    return spark.createDataFrame(docs, "doc_id bigint, text string, lang string").withColumnRenamed("lang", "TEXT"), spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int"), labels


def accuracy(rows, truth, held, limit):
    own = [(r.score >= limit) == bool(truth[r.doc_id]) for r in rows if r.doc_id in truth and truth[r.doc_id] is not None and held(r.doc_id)]
    assert len(own) > 60
    return sum(own) / len(own)


def test_toxicity_on_held_out_rows(spark, tables):
    docs, labels, raw = tables
    model = toxicity.fit(docs, labels, lambda i: queries_classifiers.remainder(i, 5) != 0)
    rows = toxicity.score(docs, model).collect()
    assert len(rows) == docs.count() and all(0 <= r.score <= 1 for r in rows)
    truth = {i: t for i, _, t in raw if i is not None and i < 900}
    assert accuracy(rows, truth, lambda i: zlib.crc32(str(i).encode()) % 5 == 0, 0.5) > 0.93
    by = {r.doc_id: r for r in rows}
    assert by[10_001].score == by[10_002].score < 0.5 and by[None].score > 0.5
    near = by[None].evidence
    assert near and all(e.label in (0, 1) for e in near) and [e.similarity for e in near] == sorted((e.similarity for e in near), reverse=True)
    assert not any(zlib.crc32(str(i).encode()) % 5 == 0 for i in model.ids)
    kept = {r[0] for r in toxicity.drop_toxic(docs, model).collect()}
    assert kept == {r.doc_id for r in rows if r.score < 0.5}


def rows_of(dense):
    return L.Rows(np.nonzero(dense)[1].astype(np.int32), dense[dense > 0].astype(np.float32), np.concatenate([[0], np.cumsum((dense > 0).sum(1))]))


@pytest.mark.parametrize(("long", "block", "texts"), [(128, 64, 128), (20, 8, 7), (1, 4, 50), (1000, 16, 3)])
def test_index_gives_exact_cosines(monkeypatch, long, block, texts):
    monkeypatch.setattr(toxicity, "LONG", long)
    monkeypatch.setattr(toxicity, "BLOCK", block)
    monkeypatch.setattr(toxicity, "TEXTS", texts)
    rng = np.random.default_rng(2)
    dense = (rng.random((300, 60)) < np.linspace(0.01, 0.4, 60)) * rng.random((300, 60))
    dense[50:90] = dense[10]  # many ties
    dense /= np.maximum(np.linalg.norm(dense, axis=1, keepdims=True), 1e-9)
    dense = dense.astype(np.float32)
    queries = np.concatenate([dense[:80], np.zeros((2, 60), np.float32)])
    near, sims = toxicity.Index(rows_of(dense), 60).nearest(rows_of(queries), 7)
    for q, at, s in zip(queries, near, sims, strict=True):
        every = np.round(dense.astype(float) @ q.astype(float), 12)
        want = np.lexsort((np.arange(300), -every))[:7]
        want = want[every[want] > 0]
        assert at[: len(want)].tolist() == want.tolist() and np.allclose(s[: len(want)], every[want], atol=1e-12) and (at[len(want) :] == -1).all()


def terms_by_hand(text, shapes):
    """Of a text of plain letters, digits and marks."""
    out, tokens = Counter(), text.split()
    for token in tokens:
        for w in re.findall(r"\w+", token.lower()):
            out.update([w] + [f"^{w[:n]}" for n in L.STEMS if len(w) > n])
        if shapes:
            out.update([f"#{m}" for m in re.findall(r"[^\w\s]{2,}|\|", token)] + ["#capitals"] * (len(token) > 1 and token.isupper()))
    if shapes:
        out.update(dict(L.shape_traits(text, len(tokens), len(set(tokens)), sum(x == y for x, y in zip(tokens, tokens[1:], strict=False)))))
    return out + Counter({f"{m}*{t}": 1 for t, n in out.items() for m in (2, 4, 8, 16) if n >= m})


def by_hand(docs, labels, ids, shapes):
    """Dense weights of all texts and of the examples, their labels and what each stands for."""
    texts = dict(docs)
    counts = {i: terms_by_hand(t or "", shapes) for i, t in texts.items()}
    ids = sorted(ids)
    y = np.array([labels[i] for i in ids])
    terms = sorted(set().union(*(counts[i] for i in ids)))
    has = np.array([[t in counts[i] for t in terms] for i in ids])
    df = np.maximum(np.array([sum(t in c for c in counts.values()) for t in terms]), 1)
    n, n1, x, each = len(ids), y.sum(), has[y == 1].sum(0), has.sum(0)
    gap, wide = x * (n - n1 - (each - x)) - (each - x) * (n1 - x), each * (n - each) * n1 * (n - n1)
    rate = np.sqrt(np.maximum(np.divide(gap.astype(float) ** 2 * n, wide, out=np.zeros(len(terms)), where=wide > 0), 0.01))
    weight = (np.log(len(texts) / df) + 1) * rate
    table = np.array([[(1 + math.log(counts[i][t])) if t in counts[i] else 0.0 for t in terms] for i in texts]) * weight
    table /= np.maximum(np.linalg.norm(table, axis=1, keepdims=True), 1e-12)
    own = dict(zip(texts, table, strict=True))
    return ids, y, own, np.array([own[i] for i in ids])


def vote(sims, y, k=10):
    order = np.lexsort((np.arange(len(sims)), -sims))[:k]
    order = order[sims[order] > 0]
    w = sims[order] ** 4
    return ((w * y[order]).sum() + 0.05 * y.mean()) / (w.sum() + 0.05), order


@pytest.fixture(scope="module")
def few(spark):
    docs, labels = make(11, 160)
    docs, truth = [(i, t) for i, t, _ in docs[:160]], {i: (q, x) for i, q, x in labels[:160]}
    frame = spark.createDataFrame(docs, "doc_id int, text string"), spark.createDataFrame([(i, *v) for i, v in truth.items()], "doc_id int, quality int, toxic int")
    return docs, truth, *frame


def test_toxicity_scores_by_hand(few):
    """Every score and every neighbour, recomputed from the texts."""
    docs, truth, frame, labels = few
    own = [i for i in truth if zlib.crc32(str(i).encode()) % 5]
    ids, y, vectors, table = by_hand(docs, {i: x for i, (_, x) in truth.items()}, own, False)
    raw = [vote(np.where(np.arange(len(ids)) == k, -1, np.round(table @ v, 6)), y)[0] for k, v in enumerate(table)]
    curve = L.platt(raw, y.astype(float), np.ones(len(y)))
    model = toxicity.fit(frame, labels, lambda i: queries_classifiers.remainder(i, 5) != 0)
    got = {r.doc_id: r for r in toxicity.score(frame, model).collect()}
    for i, v in vectors.items():
        share, order = vote(np.round(table @ v, 6), y)
        assert got[i].score == pytest.approx(L.calibrated(share, curve), abs=2e-3)
        assert [e.similarity for e in got[i].evidence] == pytest.approx((table @ v)[order], abs=1e-5)
        assert {e.id for e in got[i].evidence[:9]} <= {ids[k] for k in np.flatnonzero(table @ v >= (table @ v)[order[-1]] - 1e-5)}


def test_quality_scores_by_hand(few):
    docs, truth, frame, labels = few
    own = [i for i in truth if zlib.crc32(str(i).encode()) % 4 != 2]
    ids, y, vectors, table = by_hand(docs, {i: q for i, (q, _) in truth.items()}, own, True)
    _, _, axes = np.linalg.svd(table, full_matrices=False)
    axes = axes[:12].T
    low = {i: v @ axes for i, v in vectors.items()}
    low = {i: v / max(np.linalg.norm(v), 1e-9) for i, v in low.items()}
    block = np.array([low[i] for i in ids])
    model = quality_classifier.fit(frame, labels, lambda i: queries_classifiers.remainder(i, 4) != 2, dimensions=12)
    got = {r.doc_id: r.score for r in quality_classifier.score(frame, model).collect()}
    off = [i for i, v in low.items() if abs(vote(np.round(block @ v, 5), y)[0] - got[i]) > 2e-3]
    assert len(off) <= 1, off  # a rounded cosine at the cut may fall on the other side


def test_ties_go_to_the_smaller_id(spark):
    docs = [(i, ["red dog", "blue cat"][i % 2]) for i in range(60)] + [(100, "red dog")]
    labels = [(i, i % 2, int(i >= 20)) for i in range(60)]
    frame, own = spark.createDataFrame(docs, "doc_id int, text string"), spark.createDataFrame(labels, "doc_id int, quality int, toxic int")
    near = toxicity.score(frame, toxicity.fit(frame, own, lambda i: i.isNotNull())).where("doc_id = 100").first().evidence
    assert [e.id for e in near] == list(range(0, 20, 2))
    model = quality_classifier.fit(frame, own, lambda i: i.isNotNull())
    assert model.score(pa.array(["red dog"]))[1].tolist() == [list(range(0, 20, 2))]


def test_quality_on_held_out_rows(spark, tables):
    docs, labels, raw = tables
    model = quality_classifier.fit(docs, labels, lambda i: queries_classifiers.remainder(i, 4) != 2)
    rows = quality_classifier.score(docs, model).collect()
    truth = {i: q for i, q, _ in raw if i is not None and i < 900}
    assert accuracy(rows, truth, lambda i: zlib.crc32(str(i).encode()) % 4 == 2, 0.7) > 0.93
    assert all(0 <= r.score <= 1 for r in rows)


def test_without_labels(spark, no_docs, tables):
    docs, labels, _ = tables
    none = labels.where("false")
    for module in (toxicity, quality_classifier):
        model = module.fit(docs, none, lambda i: i.isNotNull())
        assert {r.score for r in module.score(docs, model).collect()} == {0.0}
        model = module.fit(no_docs, labels, lambda i: i.isNotNull())
        assert module.score(no_docs, model).count() == 0


def test_the_sample_is_bounded_and_weighted(spark, tables):
    docs, labels, raw = tables
    twice = docs.union(docs).union(docs.limit(100))  # rows of an id are one example
    found = L.examples(twice, labels, "toxic", lambda i: i.isNotNull(), False, "doc_id", "text", 20)
    assert len(found.ids) == len(set(found.ids)) == 40 and found.ids == sorted(found.ids)
    weight = dict(zip(found.labels, found.weights, strict=True))
    assert weight[0] > weight[1] > 1


def test_counts_agree_with_those_by_hand():
    texts = ["Vile vile VILE!! one|two grumbling grumbler ### a a a a", "", None, "  x\n\nx \t", "ab " * 40, "é.É über,Über --||-- 12_a"]
    for shapes in (False, True):
        want = [terms_by_hand(t or "", shapes) for t in texts]
        assert [Counter(d) for d in L.spelled(pa.array(texts), shapes)] == want
        terms = sorted(set().union(*want))
        got = L.Counted(pa.array(terms), shapes)(pa.array(texts))
        for i, w in enumerate(want):
            own = slice(got.starts[i], got.starts[i + 1])
            assert {terms[t]: n for t, n in zip(got.at[own], got.values[own], strict=True)} == w
        assert len(L.Counted(pa.array([], pa.string()), shapes)(pa.array(texts)).at) == 0 and len(L.Counted(pa.array(terms), shapes)(pa.array([], pa.string()))) == 0


def test_every_term_of_the_examples_counts(spark):
    """Each toxic example has an insult of its own, so no short list of terms has them all."""
    rng = random.Random(5)
    word = lambda: "".join(rng.choice("abcdefghijkl") for _ in range(6))
    name = lambda i: "".join("mnopqrstuv"[int(d)] for d in f"{i:04d}") + "zxq"
    rows = [(i, " ".join([*(word() for _ in range(20)), *([name(i % 400)] * 3 if i < 800 else [])])) for i in range(1200)]
    docs = spark.createDataFrame(rows, "doc_id int, text string")
    labels = spark.createDataFrame([(i, int(i < 800)) for i in [*range(400), *range(800, 1200)]], "doc_id int, toxic int")
    model = toxicity.fit(docs, labels, lambda i: i.isNotNull())
    assert {name(i) for i in range(400)} <= set(model.terms.to_pylist())
    only = spark.createDataFrame([(i, name(i)) for i in range(400)], "doc_id int, text string")  # nothing but the insult
    found = {r.doc_id: r for r in toxicity.score(only, model).collect()}
    assert all(found[i].score > 0.5 and found[i].evidence[0].id == i for i in range(400))
    poor = quality_classifier.fit(docs, labels, lambda i: i.isNotNull(), label="toxic")
    assert {name(i) for i in range(400)} <= set(poor.terms.to_pylist())


def test_axes_are_those_of_a_dense_decomposition():
    rng = np.random.default_rng(4)
    dense = (rng.random((60, 90)) < 0.2) * rng.random((60, 90))
    axes = quality_classifier.principal_axes(rows_of(dense), 90, 5)
    _, _, want = np.linalg.svd(dense, full_matrices=False)
    assert np.allclose(np.abs(axes.T @ want[:5].T), np.eye(5), atol=1e-4)
