"""Secrets with structural confirmation.

Plain patterns find assignments, access key ids and hex strings; these base spans stay. Longer
base64 and hex candidates are decoded and reported only if their structure holds: key encodings
whose nested lengths add up, key files with their inner lengths, armoured keys around either, and
signed tokens whose header and claims are JSON objects with an algorithm.

Defined results: null and empty texts have no spans. Rows are independent, so ties, repeated rows
and null ids come out as they went in; extra columns are not carried. Whole texts are scanned.
"""

from __future__ import annotations

import base64
import binascii
import json
import re
from bisect import bisect_left
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

from tidewell.llm import spans as S

#: Base kinds, then those that need confirmation: armoured key, key encoding, key file, signed token.
KINDS = ("assign", "access", "hex", "pem", "der", "ssh", "jwt")

ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]+")
HEX_LONG = re.compile(r"[0-9a-f]{24,}")  # the same runs, as a run is matched whole
ARMOUR = re.compile(r"-----(BEGIN|END) ([A-Z0-9 ]*PRIVATE KEY)-----")
NOT_IN_ARMOUR = re.compile(r"[^A-Za-z0-9+/=\s\\:,-]")
TOKEN = re.compile(r"(?<![A-Za-z0-9_-])([A-Za-z0-9_-]{10,})\.([A-Za-z0-9_-]{2,})\.([A-Za-z0-9_-]*)")
BLOB = re.compile(r"[A-Za-z0-9+/]{40,}={0,2}|[A-Za-z0-9_-]{40,}={0,2}")
HEX_BLOB = re.compile(r"(?:[0-9a-fA-F]{2}){20,}")
KEY_FILE = b"openssh-key-v1\0"  # fixed value: how such a file begins

HINTS = (r"(?i)passw|secret|token|api_?key", r"AKIA|-----BEGIN", r"[0-9a-f]{24}", r"[A-Za-z0-9+/_-]{40}", r"eyJ|ey[A-Za-z0-9_-]{8,}\.")


def decoded(text: str) -> bytes | None:
    body = re.sub(r"\s|\\[nr]", "", text).rstrip("=")
    body = body.replace("-", "+").replace("_", "/")
    try:
        return base64.b64decode(body + "=" * (-len(body) % 4), validate=True)
    except (binascii.Error, ValueError):
        return None


def elements(data: bytes, start: int = 0, end: int | None = None) -> list[tuple[int, int, int]] | None:
    """(tag, start, end) of the encoded elements that fill a range exactly, or None."""
    end, out = len(data) if end is None else end, []
    while start < end:
        if end - start < 2:
            return None
        tag, size, at = data[start], data[start + 1], start + 2
        if size >= 0x80:
            n = size & 0x7F
            if not 1 <= n <= 4 or at + n > end:
                return None
            size, at = int.from_bytes(data[at : at + n]), at + n
        if at + size > end:
            return None
        out.append((tag, at, at + size))
        start = at + size
    return out


def private_key(data: bytes) -> bool:
    """One sequence that fills the data: a version, then the parts of one of the private key forms."""
    top = elements(data)
    if not top or len(top) != 1 or top[0][0] != 0x30:
        return False
    parts = elements(data, *top[0][1:])
    if not parts or len(parts) < 3 or parts[0][0] != 0x02:
        return False
    tags, version = [p[0] for p in parts], int.from_bytes(data[slice(*parts[0][1:])])
    if tags[1] == 0x30 and tags[2] == 0x04:  # algorithm, then the key
        inner = elements(data, *parts[1][1:])
        return version in (0, 1) and bool(inner) and inner[0][0] == 0x06
    if tags[1] == 0x04:  # a curve's key and its parameters
        return version == 1 and all(t in (0xA0, 0xA1) for t in tags[2:])
    return version in (0, 1) and len(tags) >= 6 and all(t == 0x02 for t in tags[1:9])  # numbers only


def key_file(data: bytes) -> bool:
    """Three strings, a count, then as many public keys and the private part, each with its length."""
    if not data.startswith(KEY_FILE):
        return False
    at = len(KEY_FILE)

    def skip(at: int, times: int) -> int:
        for _ in range(times):
            if at < 0 or at + 4 > len(data):
                return -1
            at += 4 + int.from_bytes(data[at : at + 4])
        return at if at <= len(data) else -1

    at = skip(at, 3)
    if at < 0 or at + 4 > len(data):
        return False
    keys = int.from_bytes(data[at : at + 4])
    return 1 <= keys <= 16 and skip(at + 4, keys + 1) == len(data)


def structure(data: bytes | None) -> str | None:
    """The kind that decoded bytes turn out to be."""
    if not data:
        return None
    if data[0] == 0x30 and private_key(data):
        return "der"
    if key_file(data):
        return "ssh"
    if b"-----BEGIN" in data and armoured(data.decode("latin-1")):
        return "pem"
    return None


def armours(text: str) -> Iterator[tuple[str, int, int, int, int]]:
    """(what, start, body's start, body's end, end): from each opening line to the next closing one of the
    same words, if nothing between them is foreign to an armour. Lines are found once, so time is linear."""
    lines = list(ARMOUR.finditer(text))
    closing: dict[str, list[re.Match]] = {}
    for m in lines:
        if m[1] == "END":
            closing.setdefault(m[2], []).append(m)
    if not closing:
        return
    foreign, done = [m.start() for m in NOT_IN_ARMOUR.finditer(text)], 0
    for m in lines:
        of = closing.get(m[2], [])
        if m[1] == "BEGIN" and m.start() >= done and (at := bisect_left(of, m.end(), key=re.Match.start)) < len(of):
            end = of[at]
            if bisect_left(foreign, m.end()) == bisect_left(foreign, end.start()):
                yield m[2], m.start(), m.end(), end.start(), end.end()
                done = end.end()


def armoured(text: str) -> list[tuple[str, int, int]]:
    out = []
    for what, start, first, last, end in armours(text):
        # An encrypted key has header lines first; its body can only be checked for being base64.
        inner = text[first:last]
        lines = [x for x in re.split(r"\s+|\\n", inner) if x]
        body = "".join(x for x in lines if ":" not in x and "," not in x)
        data = decoded(body)
        sealed = "ENCRYPTED" in what or "ENCRYPTED" in inner or any(":" in x for x in lines)
        if data and (structure(data) in ("der", "ssh") or sealed and len(data) >= 32):
            out.append(("pem", start, end))
    return out


def json_object(part: str) -> dict | None:
    try:
        value = json.loads(decoded(part) or b"")
    except (ValueError, RecursionError):
        return None
    return value if isinstance(value, dict) else None


def signed_tokens(text: str) -> list[tuple[str, int, int]]:
    out = []
    for m in TOKEN.finditer(text):
        header = json_object(m[1])
        if header and isinstance(header.get("alg"), str) and json_object(m[2]) is not None and (m[3] or header["alg"].lower() == "none"):
            out.append(("jwt", *m.span()))
    return out


def base(text: str) -> list[tuple[str, int, int]]:
    out = [("assign", *m.span()) for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
    out += [("access", *m.span()) for m in ACCESS.finditer(text) if len(m[0]) >= 20]
    return out + [("hex", *m.span()) for m in HEX_LONG.finditer(text)]


def confirmed(text: str) -> list[tuple[str, int, int]]:
    """Candidates whose structure holds; what lies within an armoured key or a token counts as part of it."""
    out = armoured(text) + signed_tokens(text)
    for pattern, decode in ((BLOB, decoded), (HEX_BLOB, bytes.fromhex)):  # matches of one don't overlap
        held = S.Cover((a, b) for _, a, b in out)
        out += [(kind, *m.span()) for m in pattern.finditer(text) if (kind := structure(decode(m[0]))) and not held.meets(*m.span())]
    return out


def scan(texts: pa.Array) -> list[list[S.Span]]:
    out = []
    for text, look in zip(texts.to_pylist(), S.maybe(texts, *HINTS), strict=True):
        found = [(*s, True) for s in base(text)] + [(*s, False) for s in confirmed(text)] if look else []
        out.append(sorted(found, key=lambda s: (s[1], KINDS.index(s[0]))))
    return out


def find(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, spans): base spans and confirmed ones, by start, then kind."""
    return S.find(df, scan, id_col, text_col)
