"""A log of numbered commits; each holds a whole state, and a number is taken once.

A commit is written aside and then given its number by a step that fails when the number is there:
a hard link on a local disk, a rename elsewhere.  So a reader never sees half a commit, and of two
writers that saw the same state one wins and the other is told.  The store's rename must refuse
an existing target, as HDFS does.
"""

from __future__ import annotations

import json
import os
import uuid

from pyspark.sql import SparkSession


class Taken(RuntimeError):
    """Another writer took the number."""


class CommitLog:
    def __init__(self, spark: SparkSession, folder: str):
        self._jvm = spark.sparkContext._jvm
        self._folder = self._jvm.org.apache.hadoop.fs.Path(folder)
        self._fs = self._folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
        self._local = self._fs.getUri().getScheme() == "file"

    def _at(self, name: str):
        return self._jvm.org.apache.hadoop.fs.Path(self._folder, name)

    def numbers(self) -> list[int]:
        if not self._fs.exists(self._folder):
            return []
        names = (status.getPath().getName() for status in self._fs.listStatus(self._folder))
        return sorted(int(name[:-5]) for name in names if name.endswith(".json") and not name.startswith("."))

    def read(self) -> tuple[int, dict]:
        """The newest commit's number and state; 0 and nothing before the first."""
        numbers = self.numbers()
        return (numbers[-1], json.loads(self.text(f"{numbers[-1]:012d}.json"))) if numbers else (0, {})

    def text(self, name: str) -> str:
        stream = self._fs.open(self._at(name))
        try:
            return self._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def put(self, name: str, text: str) -> None:
        """A file of its own name beside the commits, which a state may name."""
        stream = self._fs.create(self._at(name), False)
        stream.write(bytearray(text.encode()))
        stream.close()

    def commit(self, after: int, state: dict) -> int:
        """Make ``state`` the commit that follows number ``after``; raises :class:`Taken`."""
        number = after + 1
        name, aside = f"{number:012d}.json", f".{uuid.uuid4().hex}"
        self.put(aside, json.dumps(state))
        try:
            if self._local:
                top = self._folder.toUri().getPath()
                os.link(f"{top}/{aside}", f"{top}/{name}")
            elif not self._fs.rename(self._at(aside), self._at(name)):
                raise FileExistsError(name)
        except FileExistsError:
            raise Taken(f"commit {number} is taken") from None
        finally:
            if self._fs.exists(self._at(aside)):
                self._fs.delete(self._at(aside), False)
        return number

    def forget(self, keep: int) -> None:
        """Drop all commits but the newest ``keep``; the newest alone says what there is."""
        for number in self.numbers()[: -max(keep, 1)]:
            self._fs.delete(self._at(f"{number:012d}.json"), False)
