"""Names of tables and columns.

A written name is either exact (in double quotes, a quote inside doubled) or plain. Plain names that
need no quotes are stored in capitals; everything else is stored as it stands. Readers see a stored
name bare if it could have been written plain, else with its quotes.
"""

from __future__ import annotations

import re

_EXACT = r'"(?:[^"]|"")*"'
_PLAIN = r"[A-Za-z_]\w*"
_DOTTED = re.compile(rf"\s*(?:{_EXACT}|[A-Za-z_][\w$]*)(?:\.(?:{_EXACT}|[A-Za-z_][\w$]*))*\s*", re.A)
_PARTS = re.compile(rf"{_EXACT}|[^.\s]+")


def quote(name: str) -> str:
    doubled = name.replace('"', '""')
    return f'"{doubled}"'


def stored_name(written: str, keep_case: bool = False) -> str:
    """The name that is stored for a written one; with ``keep_case`` plain names stay as they are."""
    if re.fullmatch(_EXACT, written):
        return written[1:-1].replace('""', '"')
    plain = re.fullmatch(_PLAIN, written, re.A)
    return written.upper() if plain and not keep_case else written


def read_name(stored: str, keep_case: bool = False) -> str:
    """The column name that a reader sees."""
    written_plain = re.fullmatch(_PLAIN, stored, re.A) and stored == stored.upper()
    return stored if keep_case or written_plain else quote(stored)


def parts(name: str) -> list[str]:
    """Stored names of the parts of a dotted name. What is no such name is an error."""
    if not _DOTTED.fullmatch(name):
        raise ValueError(f"not a table name: {name!r}")
    return [stored_name(p) if p[0] == '"' else p.upper() for p in _PARTS.findall(name)]


def parse_column_map(text: str) -> dict[str, str]:
    """``Map(a -> B, c -> D)``"""
    m = re.fullmatch(r"Map\((.+)\)", text.strip(), re.S)
    pairs = [p.split("->") for p in m[1].split(",")] if m else []
    if not pairs or any(len(p) != 2 or not p[0].strip() or not p[1].strip() for p in pairs):
        raise ValueError("a column map must look like Map(a -> B, c -> D)")
    return {a.strip(): b.strip() for a, b in pairs}
