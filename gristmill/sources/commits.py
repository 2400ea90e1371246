"""A log of numbered entries in a shared folder: each number is taken once, whoever writes."""

from __future__ import annotations

import json
import threading
import uuid

from pyspark.sql import SparkSession

#: Renaming without overwriting is one step on HDFS and its like; a local file system needs the writers of a process to take turns.
_TURN = threading.Lock()


class Conflict(RuntimeError):
    """Another writer has changed what a write was made from."""


class Folder:
    """Files and folders under a path, through Hadoop's file systems."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")
        self._path = spark._jvm.org.apache.hadoop.fs.Path
        self._fs = self._path(self.path).getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())

    def at(self, name: str):
        return self._path(f"{self.path}/{name}")

    def names(self, name: str = "") -> list[str]:
        """Sorted names in a folder; none if it isn't there."""
        where = self.at(name) if name else self._path(self.path)
        try:
            return sorted(x.getPath().getName() for x in self._fs.listStatus(where))
        except Exception as e:
            if "FileNotFoundException" in str(e):
                return []
            raise

    def text(self, name: str) -> str | None:
        """What a file says; null if it isn't there (any more)."""
        try:
            stream = self._fs.open(self.at(name))
        except Exception as e:
            if "FileNotFoundException" in str(e):
                return None
            raise
        try:
            return self.spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def create(self, name: str, text: str) -> bool:
        """Write a whole file of a name that isn't taken; false if it is."""
        draft = f".{uuid.uuid4().hex}"
        stream = self._fs.create(self.at(draft), True)
        try:
            stream.write(bytearray(text.encode()))
        finally:
            stream.close()
        return self.rename(draft, name)

    def rename(self, name: str, to: str) -> bool:
        """Give a file or folder a name that isn't taken; if it is, delete it and say no."""
        with _TURN:
            if not self._fs.exists(self.at(to)) and self._fs.rename(self.at(name), self.at(to)):
                return True
        self._fs.delete(self.at(name), True)
        return False

    def delete(self, name: str) -> None:
        self._fs.delete(self.at(name), True)


class CommitLog:
    """Entries 1, 2, ... as JSON files. An entry is there whole or not at all."""

    def __init__(self, spark: SparkSession, path: str):
        self.folder = Folder(spark, path)

    @staticmethod
    def name(n: int) -> str:
        return f"{n:020d}.json"

    def numbers(self) -> list[int]:
        return [int(x[:20]) for x in self.folder.names() if x.endswith(".json") and not x.startswith(".")]

    def head(self) -> int:
        return max(self.numbers(), default=0)

    def entry(self, n: int) -> dict | None:
        text = self.folder.text(self.name(n))
        return None if text is None else json.loads(text)

    def last(self) -> tuple[int, dict | None]:
        """Number and content of the last entry; 0 without any."""
        n = self.head()
        return n, self.entry(n) if n else None

    def commit(self, n: int, entry: dict) -> bool:
        """Add an entry under a number; false if another writer has taken it."""
        return self.folder.create(self.name(n), json.dumps(entry))

    def append(self, entry: dict, after: int | None = None) -> int:
        """Add an entry under the next free number."""
        n = (self.head() if after is None else after) + 1
        while not self.commit(n, entry):
            n = max(self.head(), n) + 1
        return n

    def forget(self, numbers: list[int]) -> None:
        for n in numbers:
            self.folder.delete(self.name(n))
