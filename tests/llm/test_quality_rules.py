import random
import re

from tidewell.llm import quality_rules as Q

SPACE = "[\x20\x09-\x0d]"


def brute(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    grams = [tuple(words[i : i + 8]) for i in range(len(words) - 7)]
    hit = {p for i, g in enumerate(grams) if grams.count(g) > 1 for p in range(i, i + 8)}
    failed = len(words) < 20 or 100 * len(hit) > 30 * len(words)
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(hit), failed


def test_measures_against_brute_force(spark):
    rng = random.Random(2)
    texts = [None, "", " \t\n", "a|b #", "x " * 100, "é ü ß " * 9, "a b c d e f g h", "a b c d e f g h " * 2]
    for k in (2, 3, 6, 40):
        texts += ["".join(rng.choice([f"w{i}" for i in range(k)]) + rng.choice([" ", " ", "\n", "  ", " #\t"]) for _ in range(rng.randrange(120))) for _ in range(40)]
    df = spark.createDataFrame([(i, t, "s") for i, t in enumerate(texts)], "doc_id int, text string, source string")
    got = {r.id: (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) for r in Q.measure(df).collect()}
    assert got == {i: brute(t) for i, t in enumerate(texts)}


def prose(rng, n=40):
    return " ".join("".join(rng.choice("abcdefghij") for _ in range(6)) for _ in range(n))


def test_lines_above_the_limit(spark, monkeypatch):
    rng = random.Random(3)
    shared, alone = "  Shared LINE of a host  ", "shared line of A host"
    rows = [(i, f"{prose(rng)}\n{shared if i % 2 else alone}", "h1") for i in range(30)]
    rows += [(100 + i, f"{prose(rng)}\n{shared}", "h2") for i in range(5)]  # too few on this host
    big = "\n".join(prose(rng, 30) for _ in range(3))
    rows += [(200 + i, f"{big}\n{prose(rng, 4)}", "h1") for i in range(30)]  # near copies
    rows += [(300 + i, "one text in full copied " + prose(random.Random(9)), "h1") for i in range(30)]
    rows += [(500 + i, f"{prose(rng)}\nexactly twenty", "h1") for i in range(20)] + [(500, f"{prose(rng)}\nexactly twenty", "h1")]
    rows += [(400, None, "h1"), (401, "", None), (0, rows[0][1], "h1")]
    df = spark.createDataFrame(rows, "doc_id int, text string, source string")
    for most in (Q.BROADCAST_LINES, 0):  # broadcast, and by salted keys
        monkeypatch.setattr(Q, "BROADCAST_LINES", most)
        got = Q.judge(df).collect()
        by = {r.id: r for r in got if r.id != 500}
        assert len(got) == len(rows)
        assert [by[i].removed_chars > 0 for i in (0, 1, 2, 29, 100, 501)] == [True, True, True, True, False, False]
        # Of copies, each is a document, and all their lines are above the limit.
        assert not any(by[i].kept or not by[i].depleted for i in (200, 201, 300, 310))
        assert by[5].kept and not by[400].kept and not by[401].kept
    cleaned = {r.doc_id: r.text for r in Q.clean(df).collect()}
    assert "hared" not in cleaned[0] and "hared" not in cleaned[1] and cleaned[1] == rows[1][1].split("\n")[0] and 201 not in cleaned


def test_a_hot_host_has_the_same_limit(spark):
    """A line in less than one percent of a host's documents goes, as it would on a small host."""
    rng = random.Random(6)
    rows = [(i, f"{prose(rng, 25)}\n{'menu of the site' if i < 21 else prose(rng, 3)}", "hot") for i in range(3000)]
    got = Q.judge(spark.createDataFrame(rows, "doc_id int, text string, source string"))
    assert {r.id for r in got.where("removed_chars > 0").collect()} == set(range(21))


def test_odd_rows(spark, odd_docs, no_docs):
    got = Q.judge(odd_docs).collect()
    assert len(got) == 7 and not any(r.kept for r in got)
    assert Q.judge(no_docs).count() == 0 and Q.clean(odd_docs).count() == 0


def test_no_python_in_the_plan(spark, odd_docs):
    plan = Q.judge(odd_docs)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
