import hashlib
import random

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import tiktoken

from tidewell.llm import byte_bpe, queries_tokens, token_counts


@pytest.fixture(scope="module")
def vocab():
    return queries_tokens.vocabulary()


@pytest.fixture(scope="module")
def reference(vocab):
    return tiktoken.Encoding("reference", pat_str=public_tokenizers.PATTERN, mergeable_ranks=vocab.ranks, special_tokens={})


def ids_of(own, text):
    return own.encode(pa.array([text])).to_pylist()[0]


ODD = [
    "", " ", "  ", "a", " a", "a ", "a  b", "a   b", "a \n b", "x\n \ny", "x\n", "\n x", "x \n", "x\n\n  y", "I'm here's 'tis it's", "\t\tq\r\n\r\n z", "é　x ñ \xa0y", "日本語 テスト 👩‍👩‍👧 ok",
    "x\x1c y\x85 z", "aaaa aaaaaaaaaaaaaaaa", "= == === ==== ===== ======", "\x00\x01", " " * 50 + "a", "١٢٣ ²³ ½ Ⅷ", "<|endoftext|> x", "é ́", "a" * 3000,
]


def test_ids_are_those_of_the_rank_encoder(vocab, reference):
    rng = random.Random(5)
    alphabet = "ab cé\n 'st1½日👍\t-=  "
    texts = ODD + ["".join(rng.choice(alphabet) for _ in range(rng.randrange(60))) for _ in range(3000)]
    own = byte_bpe.Codec(vocab)
    for part in (texts, texts[:40], texts[7:9]):  # slices of a batch, too, and pieces that are remembered
        got = own.encode(pa.array([None, *part, None]).slice(1, len(part))).to_pylist()
        for text, ids in zip(part, got, strict=True):
            assert ids == reference.encode_ordinary(text), repr(text)
    assert own.encode(pa.array([None, ""], pa.string())).to_pylist() == [[], []] and len(own.encode(pa.array([], pa.string()))) == 0


def test_memory_may_overflow(vocab, reference, monkeypatch):
    monkeypatch.setattr(byte_bpe, "CHUNK_MEMORY", 3)
    own = byte_bpe.Codec(vocab)
    for text in ("a b c d e", "f g h i", "a b c"):
        assert ids_of(own, text * 2) == reference.encode_ordinary(text * 2)


def test_another_pattern_takes_whole_texts(vocab):
    own = byte_bpe.Vocabulary(vocab.ranks, r"[a-z]+|\s|[^a-z\s]+")
    ref = tiktoken.Encoding("r", pat_str=own.pattern, mergeable_ranks=own.ranks, special_tokens={})
    got = ids_of(byte_bpe.codec(own), "ab cd  12 ef")
    assert got == ref.encode_ordinary("ab cd  12 ef")


def test_offsets_cover_the_text(vocab):
    own = byte_bpe.codec(vocab)
    for text in ODD:
        ids = np.array(ids_of(own, text), np.int32)
        if len(ids):
            starts, ends = byte_bpe.character_offsets(text, ids, own.lengths)
            assert starts[0] == 0 and ends[-1] == len(text) and (starts[1:] <= ends[:-1]).all() and (starts < ends).all()
            table = byte_bpe.byte_table(vocab).table
            for i, a, b in zip(ids.tolist(), starts.tolist(), ends.tolist(), strict=True):
                assert table[i].as_py() in text[a:b].encode()


def test_round_trip_and_split_characters(spark, vocab):
    texts = [(i, t) for i, t in enumerate(ODD)]
    df = byte_bpe.encode(spark.createDataFrame(texts, "doc_id int, text string"), vocab, offsets=True)
    out = df.withColumn("raw", byte_bpe.decode_bytes("ids", vocab)).withColumn("back", byte_bpe.decode_text("ids", vocab)).collect()
    for r in out:
        assert bytes(r.raw).decode() == r.back == ODD[r.doc_id] and len(r.ids) == len(r.starts) == len(r.ends)
    ids = ids_of(byte_bpe.codec(vocab), "👩‍👩‍👧é")
    assert "".join(byte_bpe.decode_pieces([[i] for i in ids], vocab)) == "👩‍👩‍👧é"
    assert "�" in "".join(byte_bpe.decode_pieces([ids[:1]], vocab))


def test_op1_odd_rows(spark, odd_docs, no_docs, reference):
    out = queries_tokens.digests(odd_docs).collect()
    assert len(out) == 7
    empty = hashlib.sha256(b"").hexdigest()
    by = {r.doc_id: r for r in out}
    assert by[1].n_tokens == 0 and by[1].ids_sha256 == by[2].decoded_sha256 == empty
    ids = reference.encode_ordinary("word " * 40_000)
    assert by[5].ids_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
    assert queries_tokens.digests(no_docs).count() == 0


def test_histogram_against_brute_force(spark, odd_docs, no_docs, vocab, reference):
    counted = token_counts.lengths(odd_docs, vocab)
    lengths = sorted(r.n_tokens for r in counted.collect())
    texts = ["", "", "one two", "one two", "no id here", "word " * 40_000, "\n\n  \t"]
    assert lengths == sorted(len(reference.encode_ordinary(t)) for t in texts)
    hist = token_counts.histogram(counted)
    for r in token_counts.limits(hist).collect():
        n = r.n_tokens
        assert r.n_docs == lengths.count(n) and r.docs_within == sum(x <= n for x in lengths) and r.docs_beyond == sum(x > n for x in lengths)
        assert r.tokens_within == sum(x for x in lengths if x <= n) and r.tokens_beyond == sum(x for x in lengths if x > n)
        assert r.tokens_truncated == sum(min(x, n) for x in lengths) and abs(r.quantile - r.docs_within / len(lengths)) < 1e-12
    for r in token_counts.answers(hist, [0, 3, 100, 10**9]).collect():
        assert r.tokens_truncated == sum(min(x, r.context_limit) for x in lengths) and r.docs_beyond == sum(x > r.context_limit for x in lengths)
    for r in token_counts.quantiles(hist, [0.1, 0.5, 1.0]).collect():
        assert r.n_tokens == min(x for x in lengths if sum(y <= x for y in lengths) / len(lengths) >= r.probability)
    assert token_counts.limits(token_counts.histogram(token_counts.lengths(no_docs, vocab))).count() == 0
