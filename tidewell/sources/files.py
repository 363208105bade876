"""A few file operations on whatever file system a path belongs to."""

from __future__ import annotations

import os
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

from pyspark.sql import SparkSession


@dataclass(frozen=True)
class StagedFile:
    """A file below a folder: its name from there on, and its path, size and time."""

    name: str
    path: str
    size: int
    modified: int


class Files:
    def __init__(self, spark: SparkSession, root: str) -> None:
        self.spark, self.root = spark, root.rstrip("/")
        jvm = spark.sparkContext._jvm
        self._path = jvm.org.apache.hadoop.fs.Path
        self._io = jvm.org.apache.commons.io.IOUtils
        self._fs = self._path(self.root).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def _at(self, name: str):
        return self._path(f"{self.root}/{name}" if name else self.root)

    def exists(self, name: str) -> bool:
        return self._fs.exists(self._at(name))

    def names(self, name: str = "") -> list[str]:
        at = self._at(name)
        return sorted(s.getPath().getName() for s in self._fs.listStatus(at)) if self._fs.exists(at) else []

    def text(self, name: str) -> str:
        stream = self._fs.open(self._at(name))
        try:
            return self._io.toString(stream, "UTF-8")
        finally:
            stream.close()

    def put_new(self, name: str, text: str) -> bool:
        """Write a file that must not exist yet: it appears whole or not at all, and of several writers of
        one name only one gets true. On a local disk, where a rename would replace the file, it is linked."""
        part = f"{name}.{uuid.uuid4().hex}.tmp"
        stream = self._fs.create(self._at(part), True)
        stream.write(bytearray(text.encode()))
        stream.close()
        if self._fs.getScheme() == "file":
            old, new = (self._fs.makeQualified(self._at(x)).toUri().getPath() for x in (part, name))
            try:
                os.link(old, new)
            except FileExistsError:
                return False
            finally:
                self._fs.delete(self._at(part), False)
            return True
        if self._fs.exists(self._at(name)) or not self._fs.rename(self._at(part), self._at(name)):
            self._fs.delete(self._at(part), False)
            return False
        return True

    def age(self, name: str, now_ms: float) -> float:
        """Seconds since anything in a folder, or the folder itself, was last changed."""
        at = self._at(name)
        times = [self._fs.getFileStatus(at).getModificationTime(), *(s.getModificationTime() for s in self._fs.listStatus(at))]
        return (now_ms - max(times)) / 1000

    def tree(self) -> Iterator[StagedFile]:
        """All files below the folder, in the order of their names."""
        top = self._at("")
        if not self._fs.exists(top):
            return
        base, every, found = self._fs.makeQualified(top).toString().rstrip("/") + "/", self._fs.listFiles(top, True), []
        while every.hasNext():
            s = every.next()
            path = s.getPath().toString()
            found.append(StagedFile(path.removeprefix(base), path, s.getLen(), s.getModificationTime()))
        yield from sorted(found, key=lambda f: f.name)

    def make(self, name: str) -> None:
        self._fs.mkdirs(self._at(name))

    def delete(self, name: str) -> None:
        self._fs.delete(self._at(name), True)

    def rename(self, old: str, new: str) -> bool:
        return self._fs.rename(self._at(old), self._at(new))
