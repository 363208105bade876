"""Personal data with offset-preserving deobfuscation.

Plain patterns find the base spans. A text that may hold a disguise is then rewritten by
transducers: look-alike characters become ASCII, invisible ones go, spelled digits become digits,
and written forms of @ and . become those signs. Each character of the result keeps the source
range it came from, so an identifier found there is mapped back to code points of the source.
Base spans stay as they are; a mapped span is added unless it lies within one.

Defined results: null and empty texts have no spans. Rows are independent, so ties, repeated rows
and null ids come out as they went in. Whole texts are scanned. Extra columns are not carried by
``find``; ``mask`` carries all columns as they are, whatever their names.
"""

from __future__ import annotations

import re
import unicodedata
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame

from tidewell.llm import spans as S
from tidewell.llm._common import map_rows

KINDS = ("email", "ip", "card", "phone")

EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
#: As [0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+) finds them, in linear time: a match never begins within a run of
#: digits, as it could then begin where the run does, and never ends within one.
IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
LOCAL_PART = re.compile(r"[A-Za-z0-9._%+-]")

# Letters of other scripts that look like ASCII ones, spelled digits, written signs.
LOOK_ALIKES = dict(
    zip(
        "асеһіјкоԛрѕԁуԝхАВЕЅІЈКМНОРСТУХαεικνορτυχΑΒΕΖΗΙΚΜΝΟΡΤΥΧ",
        "acehijkoqpsdywxABESIJKMHOPCTYXaeiknoptuxABEZHIKMNOPTYX",
        strict=True,
    )
)
OTHER_SIGNS = {"。": ".", "·": ".", "‐": "-", "‑": "-", "‒": "-", "–": "-", "—": "-", "−": "-", "\xa0": " "}
INVISIBLE = "​‌‍⁠﻿\xad"
DIGIT_WORDS = {
    "zero": 0, "one": 1, "two": 2, "three": 3, "four": 4, "five": 5, "six": 6, "seven": 7, "eight": 8, "nine": 9, "oh": 0,
    "null": 0, "eins": 1, "zwei": 2, "drei": 3, "vier": 4, "fünf": 5, "sechs": 6, "sieben": 7, "acht": 8, "neun": 9,
    "zéro": 0, "deux": 2, "trois": 3, "quatre": 4, "cinq": 5, "sept": 7, "huit": 8, "neuf": 9,
    "cero": 0, "uno": 1, "dos": 2, "tres": 3, "cuatro": 4, "cinco": 5, "seis": 6, "siete": 7, "ocho": 8, "nueve": 9,
}
AT_WORDS = ("at", "arroba", "arobase", "ät")
DOT_WORDS = ("dot", "punkt", "point", "punto")

_WORD = "|".join(sorted(DIGIT_WORDS, key=len, reverse=True))
_AT, _DOT = "|".join(AT_WORDS), "|".join(DOT_WORDS)
_GAP = rf"[\s,.-]{{1,3}}(?:(?:{_DOT})[\s,-]{{1,3}})?"
#: A run of three or more spelled digits; digits and written dots may stand among them.
SPELLED = re.compile(rf"(?i)(?<!\w)(?:(?P<plus>plus)[\s,-]+)?(?:{_WORD})(?:{_GAP}(?:{_WORD}|[0-9]+)){{2,}}(?!\w)")
DIGIT_WORD = re.compile(rf"(?i)(?<!\w)(?:{_WORD})(?!\w)|[0-9]")
DOT_WORD = re.compile(rf"(?i)\b(?:{_DOT})\b")
#: A spelled " at " between spaces counts if at least one dot of what follows is disguised, after plain ones
#: or not. Not taken, as prose has such words too: "jane at example.com" and "jane_at_example_dot_com".
OPEN, CLOSE = r"\s?[\[({<]\s?", r"\s?[\])}>]\s?"
SIGNS = re.compile(
    rf"(?i)(?P<at>(?<=[\w%+-]){OPEN}(?:{_AT}|@){CLOSE}(?=\w)|(?<=[\w%+-])\s(?:{_AT})\s(?=[\w-]+(?:\.[\w-]+)*(?:\s(?:{_DOT})\s|{OPEN}(?:{_DOT}|\.){CLOSE})\w))"
    rf"|(?P<dot>(?<=\w){OPEN}(?:{_DOT}|\.){CLOSE}(?=\w)|(?<=\w)\s(?:{_DOT})\s(?=\w))"
)
#: RE2 patterns of texts that are worth a second look.
BASE_HINT = r"[0-9@]"
DISGUISE_HINTS = (
    r"[^\x00-\x{9f}\x{a1}-\x{ac}\x{ae}-\x{b6}\x{b8}-\x{ff}]",
    rf"(?i)[\[({{<]\s?(?:{_AT}|{_DOT}|@|\.)\s?[\])}}>]|\s(?:{_DOT})\s",
    rf"(?i)\b(?:{_WORD}){_GAP}(?:{_WORD}|[0-9]+){_GAP}(?:{_WORD}|[0-9])",
)


def luhn(digits: str) -> bool:
    doubled = [int(d) * 2 for d in digits[-2::-2]]
    return (sum(map(int, digits[-1::-2])) + sum(d - 9 if d > 9 else d for d in doubled)) % 10 == 0


def byte_sized(part: str) -> bool:
    part = part.lstrip("0")
    return len(part) <= 3 and int(part or 0) <= 255


def emails(text: str) -> list[tuple[int, int]]:
    """As EMAIL.finditer, but it looks only around the @ signs."""
    out, done, at = [], 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and LOCAL_PART.match(text, start - 1):
            start -= 1
        m = EMAIL.match(text, start) if start < at else None
        if m:
            out.append(m.span())
            done = m.end()
        at = text.find("@", max(at + 1, done))
    return out


def identifiers(text: str) -> list[tuple[str, int, int]]:
    """By kind, then start. A match that fails its test is passed over without another try."""
    out = [("email", *s) for s in emails(text)]
    out += [("ip", *m.span()) for m in IP.finditer(text) if all(map(byte_sized, m[0].split(".")))]
    for kind, pattern in (("card", CARD), ("phone", PHONE)):
        for m in pattern.finditer(text):
            digits = re.sub("[^0-9]", "", m[0])
            if 13 <= len(digits) <= 19 and luhn(digits) if kind == "card" else 9 <= len(digits) <= 15:
                out.append((kind, *m.span()))
    return out


@lru_cache(maxsize=1)
def characters() -> dict[int, str]:
    """Look-alikes by rule (compatibility forms and digits of other scripts) and by the fixed list."""
    table = {}
    for code in range(0x100, 0x20000):
        c = chr(code)
        plain = unicodedata.normalize("NFKC", c)
        if len(plain) == 1 and plain.isascii():
            table[code] = plain
        elif (digit := unicodedata.decimal(c, None)) is not None:
            table[code] = str(digit)
    return table | {ord(a): b for a, b in (LOOK_ALIKES | OTHER_SIGNS).items()}


class Rewritten:
    """A text under rewriting: the source range of every character."""

    def __init__(self, text: str) -> None:
        self.text = text.translate(characters())  # one character for one
        self.starts = list(range(len(text)))
        self.ends = list(range(1, len(text) + 1))
        self.spelled: list[tuple[int, int]] = []

    def replace(self, edits: list[tuple[int, int, str]]) -> None:
        """Put new strings for ranges that are in order and don't overlap."""
        if not edits:
            return
        parts, starts, ends, at = [], [], [], 0
        for start, end, new in [*edits, (len(self.text), len(self.text), "")]:
            parts += [self.text[at:start], new]
            starts += self.starts[at:start]
            ends += self.ends[at:start]
            if new:
                starts += [self.starts[start]] * len(new)
                ends += [self.ends[end - 1]] * len(new)
            at = end
        self.text, self.starts, self.ends = "".join(parts), starts, ends


def rewrite(text: str) -> Rewritten:
    out = Rewritten(text)
    out.replace([(*m.span(), "") for m in re.finditer(f"[{INVISIBLE}]", out.text)])
    edits = []
    for m in SPELLED.finditer(out.text):
        # Each word becomes a digit in its own place; what stands between them goes.
        words = list(DIGIT_WORD.finditer(out.text, m.start(), m.end()))
        if m["plus"]:
            edits.append((m.start(), m.start() + 4, "+"))
        at = m.start() + 4 if m["plus"] else m.start()
        for w in words:
            if w.start() > at:
                edits.append((at, w.start(), "." if DOT_WORD.search(out.text, at, w.start()) else ""))
            edits.append((*w.span(), str(DIGIT_WORDS.get(w[0].lower(), w[0]))))
            at = w.end()
        out.spelled.append((out.starts[m.start()], out.ends[m.end() - 1]))
    out.replace(edits)
    out.replace([(*m.span(), "@" if m["at"] else ".") for m in SIGNS.finditer(out.text)])
    return out


def disguised(text: str) -> list[tuple[str, int, int]]:
    """Identifiers of the rewritten text in code points of the source, by kind, then start."""
    new = rewrite(text)
    found = [(kind, new.starts[a], new.ends[b - 1]) for kind, a, b in identifiers(new.text)]
    held = S.Cover((a, b) for _, a, b in found)
    for start, end in new.spelled:  # nine or more spelled digits are a number to call, plus sign or not
        digits = len(DIGIT_WORD.findall(text, start, end))
        if 9 <= digits <= 15 and not held.meets(start, end):
            found.append(("phone", start, end))
    return sorted(found, key=lambda s: (KINDS.index(s[0]), s[1]))


def scan(texts: pa.Array) -> list[list[S.Span]]:
    out = []
    for text, base, second in zip(texts.to_pylist(), S.maybe(texts, BASE_HINT), S.maybe(texts, *DISGUISE_HINTS), strict=True):
        own = [(*s, True) for s in identifiers(text)] if base else []
        if second:
            held = S.Cover((a, b) for _, a, b, _ in own)
            own += [(*s, False) for s in disguised(text) if not held.holds(s[1], s[2])]
            own.sort(key=lambda s: (KINDS.index(s[0]), s[1]))
        out.append(own)
    return out


def find(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, spans): base spans and added ones, by kind, then start."""
    return S.find(df, scan, id_col, text_col)


def masked(text: str, spans: list[S.Span]) -> str:
    """The text with each span, or run of overlapping spans, replaced by its kind in brackets."""
    parts, at = [], 0
    for kind, start, end, _ in sorted(spans, key=lambda s: (s[1], -s[2])):
        if start >= at:
            parts += [text[at:start], f"[{kind.upper()}]"]
        at = max(at, end)
    return "".join([*parts, text[at:]])


def mask(df: DataFrame, text_col: str = "text") -> DataFrame:
    """The same rows and columns, with personal data in the text replaced by its kind."""
    def run(texts: pa.Array) -> tuple[pa.Array, pa.Array]:
        found = scan(texts)
        out = [masked(t, s) if s else t for t, s in zip(texts.to_pylist(), found, strict=True)]
        return pa.array(out, pa.string()), pa.repeat(True, len(texts))

    return map_rows(df, text_col, run)
