"""What runs around reads and writes: last texts, actions, time zone, tags, redaction, fail points."""

from __future__ import annotations

import json
import logging
import re
import threading
import time
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

log = logging.getLogger(__name__)
_last = threading.local()
#: Statements that pre- and post-actions may be.
ALLOWED = re.compile(r"(?is)^\s*(create\s+(or\s+replace\s+)?(temporary\s+|temp\s+)?(table|view|function)|drop\s+(temporary\s+)?(table|view|function)|merge\s+into)\b")
SECRET_OPTIONS = "(?i)password|secret|token|private_key|access_?key|sas"


class ActionError(ValueError):
    """A statement that actions may not be."""


def last_select() -> str | None:
    return getattr(_last, "select", None)


def last_load() -> str | None:
    return getattr(_last, "load", None)


def note(kind: str, text: str) -> None:
    setattr(_last, kind, text)


def statements(text: str | None, table: str | None = None) -> list[str]:
    """Statements of an action text: parted by semicolons, with %s for the table."""
    out = [s.strip() for s in (text or "").split(";") if s.strip()]
    return [s.replace("%s", table) if table else s for s in out]


def run_actions(spark: SparkSession, text: str | None, table: str | None = None) -> None:
    """Run pre- or post-actions. They come from explicit options only, never from the session."""
    every = statements(text, table)
    for s in every:
        if not ALLOWED.match(s):
            raise ActionError(f"not allowed as an action: {s[:60]!r}")
    for s in every:
        spark.sql(s)


@contextmanager
def time_zone(spark: SparkSession, zone: str | None) -> Iterator[None]:
    """The session's time zone for a read or write: the given one; ``spark`` and names of a
    warehouse's own settings leave it as it is."""
    if not zone or zone.lower() in ("spark", "sf_current", "sf_default"):  # fixed values
        yield
        return
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        yield
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


def register_redaction(spark: SparkSession) -> None:
    """Hide secret options in plans and logs, before anything is read or written."""
    key = "spark.sql.redaction.options.regex"
    now = spark.conf.get(key, "")
    if SECRET_OPTIONS not in now:
        spark.conf.set(key, f"{now}|{SECRET_OPTIONS}" if now else SECRET_OPTIONS)


class Jobs:
    """Tagged jobs that can be cancelled together; a closed group takes no more work."""

    def __init__(self, spark: SparkSession, tag: str) -> None:
        self.spark, self.tag, self.closed = spark, tag, False

    @contextmanager
    def running(self) -> Iterator[None]:
        if self.closed:
            raise RuntimeError(f"{self.tag} is closed")
        self.spark.addTag(self.tag)
        try:
            yield
        finally:
            self.spark.removeTag(self.tag)

    def close(self) -> None:
        self.closed = True
        self.spark.interruptTag(self.tag)


def report(kind: str, what: str, began: float, rows: int | None = None, error: BaseException | None = None) -> None:
    """One line of the log for each read, write and load: what, how long, how many rows, and how it ended."""
    state = {"kind": kind, "what": what, "seconds": round(time.monotonic() - began, 3), "rows": rows, "status": "failed" if error else "done"}
    if error:
        state["error"] = type(error).__name__
    log.info("%s", json.dumps(state))


#: Fail points that tests arm: names of steps of a write.
_armed: set[str] = set()


class InjectedFailure(RuntimeError):
    """Raised where a test has asked for it."""


@contextmanager
def fail_at(*steps: str) -> Iterator[None]:
    _armed.update(steps)
    try:
        yield
    finally:
        _armed.difference_update(steps)


def reached(step: str) -> None:
    if step in _armed:
        raise InjectedFailure(step)
