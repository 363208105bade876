"""Byte-level BPE encoding and decoding with the tokenizers library over Arrow batches.

A rank file (base64 token, rank) becomes a BPE model whose alphabet is the usual byte-to-character
table: printable Latin-1 bytes stand for themselves, the others for code points from 256 on. Every
split of a token into two tokens becomes a merge of that token's rank, so the model merges the same
pairs as a rank-based encoder does.

Defined results: a null text is encoded as an empty one (no ids). Empty text: no ids. Rows are
independent of each other, so repeated rows, ties and null ids come out as they went in; an empty
table gives an empty table. Extra columns are not carried and so can't clash. Whole texts are
encoded, in slices of bounded size for memory (a single long text is one slice).
"""

from __future__ import annotations

import base64
import codecs
import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewell.llm._common import arrow_map, built, pick, relieve, spread

#: Fixed value: the split pattern of the public byte-level vocabularies. A space that follows a
#: character other than white space always begins a new match of it.
SPACE_STARTS_MATCH = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""

#: Entries of a worker's memory of encoded pieces; beyond it the memory starts anew.
CHUNK_MEMORY = 100_000

#: Pieces that are encoded in one call.
JOINED = 4096


def byte_characters() -> list[str]:
    """The character that stands for each byte: printable bytes for themselves, the rest from 256 on."""
    out, spare = [], 256
    for b in range(256):
        if 33 <= b <= 126 or 161 <= b <= 255 and b != 173:
            out.append(chr(b))
        else:
            out.append(chr(spare))
            spare += 1
    return out


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}


class Vocabulary:
    """Ranks and split pattern; small (a megabyte or two), so it travels with the tasks."""

    def __init__(self, ranks: dict[bytes, int], pattern: str) -> None:
        self.ranks, self.pattern = ranks, pattern
        joined = b"".join(b"%d:%d:" % (rank, len(token)) + token for token, rank in ranks.items())
        self.key = hashlib.sha256(joined + pattern.encode()).hexdigest()

    @classmethod
    def from_file(cls, path: str, pattern: str = SPACE_STARTS_MATCH) -> Vocabulary:
        return cls(read_ranks(path), pattern)

    def tokenizer(self):
        from tokenizers import Regex, Tokenizer, decoders, models, pre_tokenizers

        chars = byte_characters()
        spell = lambda token: "".join(chars[b] for b in token)
        merges = [
            (spell(token[:i]), spell(token[i:]))
            for token, _ in sorted(self.ranks.items(), key=lambda x: x[1])
            for i in range(1, len(token))
            if token[:i] in self.ranks and token[i:] in self.ranks
        ]
        model = models.BPE(vocab={spell(t): r for t, r in self.ranks.items()}, merges=merges, ignore_merges=True)
        out = Tokenizer(model)
        out.pre_tokenizer = pre_tokenizers.Sequence(
            [pre_tokenizers.Split(Regex(self.pattern), "isolated"), pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)]
        )
        out.decoder = decoders.ByteLevel()
        return out


class ByteTable:
    """The bytes of each id, for decoding: the byte-to-character table read backwards."""

    def __init__(self, vocabulary: Vocabulary) -> None:
        chars = byte_characters()
        reverse = {c: b for b, c in enumerate(chars)}
        table = [b""] * (max(vocabulary.ranks.values(), default=-1) + 1)
        for token, i in vocabulary.ranks.items():
            spelled = "".join(chars[b] for b in token)
            table[i] = bytes(reverse[c] for c in spelled)
        self.table = pa.array(table, pa.large_binary())
        self.lengths = np.array([len(x) for x in table], np.int64)

    def decode(self, lists: pa.ListArray) -> pa.Array:
        """The bytes of each list of ids, joined; null gives null."""
        flat = self.table.take(lists.flatten())
        lengths = np.asarray(lists.value_lengths().fill_null(0), np.int64)
        ends = np.cumsum(np.concatenate([[0], self.lengths[np.asarray(lists.flatten(), np.int64)]]))[np.cumsum(np.concatenate([[0], lengths]))]
        data = flat.buffers()[2]
        whole = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(lists), [None, pa.py_buffer(ends.astype(np.int64)), data if data is not None else pa.py_buffer(b"")])
        out = whole.cast(pa.binary())
        return pc.if_else(lists.is_null(), pa.scalar(None, pa.binary()), out) if lists.null_count else out


class Codec:
    """What a Python worker keeps of a vocabulary: the tokenizer, a bounded memory of chunks that
    it has encoded, and the byte string of each id."""

    def __init__(self, vocabulary: Vocabulary) -> None:
        self.tokenizer = vocabulary.tokenizer()
        self.by_chunk = vocabulary.pattern == SPACE_STARTS_MATCH
        self.memory: dict[str, bytes] = {}
        self.bytes = ByteTable(vocabulary)
        self.lengths = self.bytes.lengths
        relieve()  # the merges are a large list

    def _encode(self, texts: list[str]) -> list[np.ndarray]:
        return [np.array(e.ids, np.int32) for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def encode(self, texts: pa.Array) -> pa.ListArray:
        """The ids of each text; null counts as empty. A text is cut at its spaces, as each begins a new
        match of the pattern; each distinct piece is encoded once, and lists are put together from numbers."""
        texts = pc.fill_null(texts, "")
        if not self.by_chunk or not len(texts):
            return id_lists(self._encode(texts.to_pylist()))
        split = pc.split_pattern(texts, " ")
        starts = np.concatenate([[0], np.cumsum(split.value_lengths().to_numpy(zero_copy_only=False))]).astype(np.int64)
        coded = split.flatten().dictionary_encode()
        chunks, code = coded.dictionary.to_pylist(), coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
        row, first, last = np.repeat(np.arange(len(texts)), np.diff(starts)), starts[:-1], starts[1:] - 1
        # After an empty piece or white space, a space need not begin a match: such texts go as a whole. But
        # white space at the end of a text is as good as any other piece, as nothing follows it.
        bad = np.fromiter((not c or c[-1].isspace() for c in chunks), bool, len(chunks))[code]
        n_bad, empty = np.add.reduceat(bad, first, dtype=np.int64), np.fromiter((not c for c in chunks), bool, len(chunks))
        tail = bad[last] & (n_bad == 1) & (last > first) & ~empty[code[last]]
        whole = (n_bad > 0) & ~tail
        plain = ~bad & ~whole[row]
        plain[first] = False
        pool, start, size = self._pieces(chunks, code[plain])
        at, n = start[code], size[code]
        n[~plain] = 0
        # The first piece of a text has no space before it; it also stands for a text that goes as a whole.
        rows = np.concatenate([np.flatnonzero(~whole), np.flatnonzero(whole), np.flatnonzero(tail)])
        places = np.concatenate([first[~whole], first[whole], last[tail]])
        single = [chunks[c] for c in code[first[~whole]]] + texts.filter(pa.array(whole)).to_pylist() + [" " + chunks[c] for c in code[last[tail]]]
        if len(rows):
            ids = self._encode(single)
            n[places] = np.fromiter(map(len, ids), np.int64, len(ids))
            at[places] = len(pool) + np.cumsum(n[places]) - n[places]
            pool = np.concatenate([pool, *ids])
        values = pool[spread(at, n)[0]]
        ends = np.concatenate([[0], np.cumsum(np.add.reduceat(n, first))])
        return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(values, pa.int32()))

    def _pieces(self, chunks: list[str], code: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids of the pieces that are used, one after the other, and where those of each begin and how many
        they are. Pieces that a slice has twice are likely in the next one, too, and are remembered."""
        often = np.bincount(code, minlength=len(chunks))
        used, memory = np.flatnonzero(often), self.memory
        new = [c for c in used.tolist() if chunks[c] not in memory]
        parts = [(c, memory[chunks[c]]) for c in used.tolist() if chunks[c] in memory]
        if len(memory) > CHUNK_MEMORY:
            memory.clear()
        for part in range(0, len(new), JOINED):
            some = new[part : part + JOINED]
            parts += zip(some, self._encode_joined([chunks[c] for c in some]), strict=True)
        memory.update((chunks[c], ids) for c, ids in parts if often[c] > 1)
        start, size = np.zeros(len(chunks), np.int64), np.zeros(len(chunks), np.int64)
        order = np.fromiter((c for c, _ in parts), np.int64, len(parts))
        size[order] = np.fromiter((len(ids) // 4 for _, ids in parts), np.int64, len(parts))
        start[order] = np.cumsum(size[order]) - size[order]
        return np.frombuffer(b"".join(ids for _, ids in parts), np.int32), start, size

    def _encode_joined(self, chunks: list[str]) -> Iterator[bytes]:
        """Pieces that follow a space are encoded as one text, which saves a call for each, and cut
        apart again where the bytes of the pieces end; no token reaches over such a place."""
        ids = self._encode([" " + " ".join(chunks)])[0]
        sizes = np.fromiter((len(c.encode()) + 1 for c in chunks), np.int64, len(chunks))
        cuts = np.searchsorted(np.cumsum(self.lengths[ids]), np.cumsum(sizes)) + 1
        start = 0
        for cut in cuts.tolist():
            yield ids[start:cut].tobytes()
            start = cut


def codec(vocabulary: Vocabulary) -> Codec:
    return built("byte_bpe.codec", vocabulary.key, lambda: Codec(vocabulary))


def byte_table(vocabulary: Vocabulary) -> ByteTable:
    return built("byte_bpe.bytes", vocabulary.key, lambda: ByteTable(vocabulary))


def id_lists(encoded: list[np.ndarray]) -> pa.ListArray:
    ends = np.cumsum([0, *map(len, encoded)], dtype=np.int64)
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.concatenate([np.empty(0, np.int32), *encoded]), pa.int32()))


def character_offsets(text: str, ids: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and end of each token in code points. A token that holds part of a character covers
    the whole character, so neighbours may overlap there."""
    raw = np.frombuffer(text.encode(), np.uint8)
    char_of = np.cumsum((raw & 0xC0) != 0x80) - 1
    ends = np.cumsum(lengths[ids])
    starts = ends - lengths[ids]
    return char_of[starts], char_of[ends - 1] + 1


def encode(df: DataFrame, vocabulary: Vocabulary, id_col: str = "doc_id", text_col: str = "text", offsets: bool = False, decoded: bool = False) -> DataFrame:
    """(id, ids array<int>) of every row; with ``offsets`` also (starts, ends) of each id in code
    points of the text, with ``decoded`` also the bytes that the ids are decoded to in the same pass."""
    rows = pick(df, id=id_col, text=text_col)
    id_type = rows.schema["id"].dataType.simpleString()
    schema = f"id {id_type}, ids array<int>" + ", starts array<int>, ends array<int>" * offsets + ", decoded binary" * decoded
    shared = rows.sparkSession.sparkContext.broadcast(vocabulary)  # bounded: a vocabulary file

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        own = codec(shared.value)
        columns = [batch.column(0), own.encode(batch.column(1))]
        if offsets:
            ids = [x.values.to_numpy() for x in columns[1]]
            both = [character_offsets(t, i, own.lengths) if len(i) else ((), ()) for t, i in zip(batch.column(1).to_pylist(), ids, strict=True)]
            columns += [pa.array([list(x[k]) for x in both], pa.list_(pa.int32())) for k in (0, 1)]
        if decoded:
            columns.append(own.bytes.decode(columns[1]))
        return pa.RecordBatch.from_arrays(columns, names=["id", "ids", *["starts", "ends"] * offsets, *["decoded"] * decoded])

    return arrow_map(rows, run, schema).withColumnRenamed("id", id_col)


def decode_bytes(ids: Column | str, vocabulary: Vocabulary) -> Column:
    """The bytes that an array of ids stands for. Null gives null; an unknown id is an error."""
    shared = _session().sparkContext.broadcast(vocabulary)

    @F.arrow_udf("binary")
    def run(lists: pa.Array) -> pa.Array:
        return byte_table(shared.value).decode(lists)

    return run(ids)


def decode_text(ids: Column | str, vocabulary: Vocabulary) -> Column:
    """The text that an array of ids stands for; bytes that end or begin within a character become
    U+FFFD, as they can't be told from broken input."""
    raw = decode_bytes(ids, vocabulary)

    @F.arrow_udf("string")
    def run(values: pa.Array) -> pa.Array:
        return pa.array([None if v is None else v.decode("utf-8", "replace") for v in values.to_pylist()], pa.string())

    return run(raw)


def decode_pieces(pieces: Iterable[list[int]], vocabulary: Vocabulary) -> Iterator[str]:
    """Text of consecutive runs of ids, as they arrive: a character that is split over two runs
    comes out whole with the later one."""
    own, held = byte_table(vocabulary), codecs.getincrementaldecoder("utf-8")("replace")
    for ids in pieces:
        yield held.decode(b"".join(own.table[i].as_py() for i in ids))
    if rest := held.decode(b"", final=True):
        yield rest


def _session():
    from pyspark.sql import SparkSession

    return SparkSession.active()
