"""Numbered versions of a small description, such as which folders make up a table.

A version is one JSON file, ``<path>/_versions/<number>.json``. It is written under another name
and then renamed, which fails if the number is taken; so a version is there as a whole or not at
all, and of two writers one is told to try again. Data that no version names does not exist for
readers, whoever left it behind. Only the driver reads and writes these files, through Hadoop's file
systems, so any store that Spark can use will do.
"""

from __future__ import annotations

import json
import uuid
from dataclasses import dataclass

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession


class VersionConflict(RuntimeError):
    """Another writer has committed the version in the meantime."""


@dataclass(frozen=True)
class Version:
    number: int
    content: dict


class VersionLog:
    """The versions under a path. Nothing is there before the first commit."""

    def __init__(self, spark: SparkSession, path: str):
        self.path = path.rstrip("/")
        self._jvm = spark._jvm
        self._conf = spark._jsc.hadoopConfiguration()
        self._folder = self._path(f"{self.path}/_versions")
        self._files = self._folder.getFileSystem(self._conf)

    def _path(self, text: str):
        return self._jvm.org.apache.hadoop.fs.Path(text)

    def _file(self, number: int):
        return self._path(f"{self.path}/_versions/{number:020d}.json")

    def numbers(self) -> list[int]:
        if not self._files.exists(self._folder):
            return []
        names = (status.getPath().getName() for status in self._files.listStatus(self._folder))
        return sorted(int(name[:-5]) for name in names if name.endswith(".json") and name[0] != ".")

    def read(self, number: int) -> Version:
        stream = self._files.open(self._file(number))
        try:
            text = self._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()
        return Version(number, json.loads(text))

    def latest(self) -> Version | None:
        numbers = self.numbers()
        return self.read(numbers[-1]) if numbers else None

    def commit(self, base: Version | None, content: dict) -> Version:
        """The next version after ``base``; ``VersionConflict`` if there is one already."""
        number = base.number + 1 if base else 1
        self._files.mkdirs(self._folder)
        draft = self._path(f"{self.path}/_versions/.{uuid.uuid4().hex}.tmp")
        stream = self._files.create(draft, False)
        try:
            stream.write(json.dumps(content).encode())
        finally:
            stream.close()
        context = self._jvm.org.apache.hadoop.fs.FileContext.getFileContext(
            self._folder.toUri(), self._conf
        )
        qualified = [self._files.makeQualified(path) for path in (draft, self._file(number))]
        kind = self._jvm.org.apache.hadoop.fs.Options.Rename
        options = self._jvm.java.lang.reflect.Array.newInstance(kind.NONE.getClass(), 0)
        try:
            context.rename(*qualified, options)
        except Py4JJavaError as error:
            self._files.delete(draft, False)
            if "FileAlreadyExists" not in str(error.java_exception.getClass().getName()):
                raise
            raise VersionConflict(f"{self.path}: version {number} is taken") from None
        return Version(number, content)

    def forget(self, keep: int) -> list[Version]:
        """Drops all but the last ``keep`` versions and returns what was dropped, oldest first."""
        dropped = [self.read(number) for number in self.numbers()[:-keep]]
        for version in dropped:
            self._files.delete(self._file(version.number), False)
        return dropped

    def delete_data(self, folder: str) -> None:
        self._files.delete(self._path(f"{self.path}/{folder}"), True)

    def data_folders(self, under: str = "") -> list[str]:
        path = self._path(f"{self.path}/{under}".rstrip("/"))
        if not self._files.exists(path):
            return []
        names = [status.getPath().getName() for status in self._files.listStatus(path)]
        return sorted(name for name in names if name != "_versions")
