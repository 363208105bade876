import random
import re

from tidewell.llm import decontamination as D

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def split(text):
    low = (text or "").translate({c: c + 32 for c in range(65, 91)})
    return WORD.findall(low)


def brute(text, items, window):
    words, hit, names = split(text), set(), set()
    for name, item in items:
        own = split(item)
        k = min(window, len(own))
        grams = {tuple(own[i : i + k]) for i in range(len(own) - k + 1)} if own else set()
        for i in range(len(words) - k + 1):
            if grams and tuple(words[i : i + k]) in grams:
                hit.update(range(i, i + k))
                names.add(str(name))
    return len(words), len(hit), sorted(names)


def test_against_brute_force(spark):
    rng = random.Random(1)
    make = lambda n, k: " ".join(rng.choice("abcdefgh"[:k]) for _ in range(n))
    for window, block in ((10, 10**6), (4, 10**6), (3, 20)):
        items = [(i, make(rng.randrange(0, 16), 3)) for i in range(25)] + [(7, make(12, 2)), (None, make(9, 2)), (99, None), (100, "A b. C")]
        docs = [(i, make(rng.randrange(0, 80), 4)) for i in range(200)] + [(500, None), (501, ""), (502, "a B,c a"), (500, "a b c " * 3000)]
        # A text in full, in other case and with other marks, beside words of its own.
        docs += [(600, "zz " + items[3][1].upper().replace(" ", ", ") + " zz")]
        d = spark.createDataFrame(docs, "doc_id int, text string").repartition(3)
        got = D.scan(d, spark.createDataFrame(items, "item_id int, text string"), window=window, block_words=block).collect()
        want = sorted((i, *brute(t, [x for x in items if x[0] is not None], window)) for i, t in docs)
        assert sorted((r.doc_id, r.n_words, r.n_hit, r.item_ids) for r in got) == want


def test_words_beyond_ascii():
    text = "Ünï-CODE x7Y \x7f_日本 É é"
    assert [w.decode() for w in D.words(text)] == split(text)


def test_clean_cuts_and_drops(spark):
    items = spark.createDataFrame([(1, "one two three four five six seven eight nine ten eleven")], "item_id int, text string")
    own = "alpha beta gamma delta epsilon zeta eta theta iota kappa lamda mu"
    rows = [(1, f"{own}. One, two three four five six seven eight nine ten eleven! End", "k"), (2, "one two three four five six seven eight nine ten", "k"), (3, own, "k"), (4, None, "k"), (5, "", "k")]
    docs = spark.createDataFrame(rows, "doc_id int, text string, z string").withColumnRenamed("z", "TEXT")
    out = {r[0]: r[1] for r in D.clean(docs, items).collect()}
    assert out == {1: f"{own}. ! End", 3: own, 4: None, 5: ""}


def test_cleaning_by_several_blocks_is_that_by_one(spark):
    rng = random.Random(3)
    make = lambda n: " ".join(rng.choice("abcdef") for _ in range(n))
    items = spark.createDataFrame([(i, make(rng.randrange(3, 9))) for i in range(30)], "item_id int, text string")
    rows = [(i % 50, make(rng.randrange(0, 60)), "k") for i in range(100)] + [(None, make(9), "k"), (7, None, None), (7, "", "k")]
    docs = spark.createDataFrame(rows + rows[:5], "doc_id int, text string, z string").withColumnRenamed("z", "_row").repartition(4)
    one, several = (sorted(map(str, D.clean(docs, items, window=5, block_words=n).collect())) for n in (10**6, 25))
    assert one == several and 0 < len(one) < len(rows) + 5
    assert len(D.blocks(items, "item_id", "text", 25)) > 3


def test_empty_tables(spark, odd_docs, no_docs):
    none = spark.createDataFrame([], "item_id bigint, text string")
    assert {r.n_hit for r in D.scan(odd_docs, none).collect()} == {0}
    assert D.scan(no_docs, none).count() == 0 and D.clean(odd_docs, none).count() == 7
