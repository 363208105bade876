import random

import pytest

from tidewell.llm import near_dedup as N
from tidewell.llm.components import components


def brute(rows, size, percent):
    sets = []
    for _, text in rows:
        words = (text or "").translate({c: c + 32 for c in range(65, 91)}).encode().split()
        k = min(size, len(words))
        sets.append({tuple(words[i : i + k]) for i in range(len(words) - k + 1)} if words else set())
    up = list(range(len(rows)))

    def top(x):
        while up[x] != x:
            x = up[x]
        return x

    for i, a in enumerate(sets):
        for j in range(i):
            if rows[i][0] is not None and rows[j][0] is not None and a and sets[j] and 100 * len(a & sets[j]) >= percent * len(a | sets[j]):
                up[top(i)] = top(j)
    least = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            least[top(i)] = min(d, least.get(top(i), d))
    return sorted(((d, len(sets[i]), least.get(top(i)) if d is not None else None) for i, (d, _) in enumerate(rows)), key=str)


def corpus(seed):
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("abcdefghij") for _ in range(4))
    base = [[word() for _ in range(rng.choice((3, 12, 60, 150, 400)))] for _ in range(25)]
    passage = [word() for _ in range(60)]
    rows, n = [], 1000
    for b in base:
        for _ in range(rng.choice((1, 2, 6))):
            c = [w if rng.random() > 0.02 else word() for w in b]
            rows.append((n, " ".join(c)))
            n += 1
    # A chain: each is similar to the next, the ends are not.
    chain = [word() for _ in range(100)]
    for k in range(6):
        rows.append((n, " ".join(chain[4 * k : 4 * k + 70])))
        n += 1
    rows += [(n + i, " ".join([word() for _ in range(rng.choice((20, 200)))] + passage)) for i in range(30)]
    rows += [(n + 100 + i, " ".join(base[2])) for i in range(5)]
    rows += [(5, None), (6, ""), (7, "x"), (8, "X"), (9, " \t"), (None, "x"), (7, "x"), (10, "a b c d e")]
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize(("limit", "seed", "size"), [(64, 1, 5), (3, 2, 4), (2, 3, 4)])
def test_against_brute_force(spark, monkeypatch, limit, seed, size):
    monkeypatch.setattr(N, "LIST", limit)
    monkeypatch.setattr(N, "BLOCK", 7)
    monkeypatch.setattr(N, "SLICE", 4)
    if seed == 2:  # nothing is broadcast
        monkeypatch.setattr(N, "BROADCAST_IDS", 0)
    rows = corpus(seed)
    got = N.near_duplicates(spark.createDataFrame(rows, "doc_id int, text string"), size=size).collect()
    assert sorted(((r.doc_id, r.n_shingles, r.component_id) for r in got), key=str) == brute(rows, size, 80)
    assert all(r.kept == (r.doc_id is None or r.doc_id == r.component_id) for r in got)


def test_a_large_group_of_near_copies(spark, monkeypatch):
    monkeypatch.setattr(N, "LIST", 8)
    monkeypatch.setattr(N, "BLOCK", 16)
    rng = random.Random(8)
    word = lambda: "".join(rng.choice("abcdefghij") for _ in range(4))
    base = [word() for _ in range(90)]
    rows = [(i, " ".join(w if rng.random() > 0.045 else word() for w in base)) for i in range(120)]
    got = N.near_duplicates(spark.createDataFrame(rows, "doc_id int, text string"), size=4).collect()
    assert sorted(((r.doc_id, r.n_shingles, r.component_id) for r in got), key=str) == brute(rows, 4, 80)


def test_drop_duplicates(spark, odd_docs, no_docs):
    kept = N.drop_duplicates(odd_docs)
    assert kept.columns == odd_docs.columns
    assert sorted(str(r[0]) for r in kept.collect()) == ["1", "2", "3", "5", "6", "None"]
    assert N.drop_duplicates(no_docs).count() == 0


def test_components(spark):
    edges = [(i, i + 1) for i in range(1, 60)] + [(100, i) for i in range(101, 140)] + [(7, 7), (200, 201), (201, 200)]
    got = {r.node: r.root for r in components(spark.createDataFrame(edges, "a int, b int")).collect()}
    assert got == {**{i: 1 for i in range(2, 61)}, **{i: 100 for i in range(101, 140)}, 201: 200}
    assert components(spark.createDataFrame([], "a int, b int")).count() == 0


def test_chances():
    assert N.least_shared(16, 80) >= 3 and 60 <= N.least_shared(128, 80) <= 80
    with pytest.raises(ValueError):
        N.near_duplicates(_frame(), percent=50)


def _frame():
    from pyspark.sql import SparkSession

    return SparkSession.active().createDataFrame([], "doc_id int, text string")


def test_texts_of_one_id_are_judged_by_themselves(spark):
    a, b = (" ".join(f"{w}{i}" for i in range(40)) for w in "ab")
    df = spark.createDataFrame([(1, a), (2, a), (2, b), (3, ""), (4, a), (4, "")], "doc_id int, text string")
    assert sorted(map(tuple, N.drop_duplicates(df).collect())) == [(1, a), (2, b), (3, ""), (4, "")]


def test_many_classes_that_share_a_passage(spark):
    """Most of each text is a passage that all have; only copies of the own part are linked."""
    rng = random.Random(21)
    word = lambda: "".join(rng.choice("abcdefghij") for _ in range(5))
    passage = " ".join(word() for _ in range(60))
    rows = [(i, " ".join(word() for _ in range(50)) + " " + passage) for i in range(5000)]
    rows += [(10_000 + i, f"{rows[i][1]} {word()}") for i in range(0, 5000, 250)]
    got = N.near_duplicates(spark.createDataFrame(rows, "doc_id int, text string").repartition(4), size=4).collect()
    assert {r.doc_id: r.component_id for r in got} == {i: i % 10_000 if i >= 10_000 else i for i, _ in rows}
