"""Raw CSV scan."""

from __future__ import annotations

import functools
import re
from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from carebase.datasets import ID_COLUMNS
from carebase.functions.columns import quoted
from carebase.functions.names import normalize_name, normalize_names

# The beginning of a file that is read to find its header, and how many files at a time.
HEAD_BYTES, READERS = 2**16, 16

# Conditions that mean "nothing there": an absent path, or a folder without files.
MISSING_SOURCE_CONDITIONS = ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA")


class NoColumns(ValueError):
    """The source exists but has no header and no rows."""


def is_missing_source(error: Exception) -> bool:
    return isinstance(error, AnalysisException) and error.getCondition() in MISSING_SOURCE_CONDITIONS


def scan_csv(
    spark: SparkSession,
    paths: str | list[str],
    *,
    header: bool = True,
    sep: str = ",",
    multi_line: bool = True,
    infer: bool = True,
    base_path: str | None = None,
) -> DataFrame:
    """CSV folder, file or list of files; quotes inside quoted fields are doubled.

    ``infer=False`` reads every column as text and touches only the first header, so it
    costs no pass over the data. With ``infer=True`` Spark reads the data once more to
    find types; id columns stay text even then, because ``015009`` and ``01E193`` would
    turn into numbers.

    ``multi_line=True`` is right for every file, but Spark then gives each file to one
    task. Turn it off for sources without line breaks inside fields and with one kind of line
    end, so that large files are split. Nothing but this argument decides: the size of a file
    never does.

    All files must have one header, see ``header_groups``.
    """
    options = {"header": header, "sep": sep, "multiLine": multi_line, "quote": '"', "escape": '"'}
    if base_path:
        options["basePath"] = base_path
    df = spark.read.options(**options, inferSchema=infer).csv(paths)
    if not df.columns:
        return df
    schema = T.StructType(
        [
            T.StructField(field.name, T.StringType())
            if normalize_name(field.name) in ID_COLUMNS
            else field
            for field in df.schema
        ]
    )
    return spark.read.options(**options).schema(schema).csv(paths)


def with_file(raw: DataFrame, name: str) -> DataFrame:
    """``raw`` as text under normalised names, with the file of each row as the last column.

    Only columns made of folder names such as ``k=1`` are not text before.
    """
    file_path = raw.metadataColumn("_metadata").getField("file_path")
    names = normalize_names(raw.columns)
    located = raw.select("*", file_path).toDF(*names, name)
    folders = {
        new: F.col(quoted(new)).cast("string")
        for new, (_, kind) in zip(names, raw.dtypes, strict=True)
        if kind != "string"
    }
    return located.withColumns(folders) if folders else located


def united(parts: Sequence[DataFrame], file: str) -> DataFrame:
    """Rows of ``with_file`` frames, by name; the first frame's columns come first, the file last.

    Columns that a file does not have are null in its rows. The types of the frames must agree.
    """
    names = dict.fromkeys(name for df in parts for name in df.columns[:-1])
    whole = functools.reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
    return whole.select(*map(quoted, names), quoted(file))


@dataclass(frozen=True)
class RawFiles:
    """``groups`` of files with equal headers, in the order of their names; ``total`` bytes."""

    groups: list[str | list[str]]
    total: int
    base_path: str | None


def header_groups(
    spark: SparkSession,
    paths: str | list[str],
    *,
    header: bool = True,
    sep: str = ",",
    multi_line: bool = True,
) -> RawFiles:
    """The files under ``paths``, grouped by the text of their header row.

    Only the beginning of each file is read, by some threads of the driver, through Spark's own file
    systems and codecs; nothing but its distinct header texts and the file names is kept, which
    Spark's file index holds anyway. Headers that differ in their text alone, as by quotes, make groups
    too; that changes no row. Files without any record belong to no group. If there is one group, it
    is ``paths`` as given; so a folder stays one, however many files it has.
    """
    files = spark.read.format("binaryFile").load(paths).select("path", "length").orderBy("path")
    total, listed = 0, []
    for path, length in files.toLocalIterator():
        total += length
        if length:
            listed.append(path)
    if not header or len(listed) < 2:
        return RawFiles([paths] if listed else [], total, None)
    reader = _HeadReader(spark, sep, multi_line)
    groups: dict[str, list[str]] = {}
    with ThreadPoolExecutor(READERS) as pool:
        for path, text in zip(listed, pool.map(reader.head, listed), strict=True):
            if text:
                groups.setdefault(text, []).append(path)
    if len(groups) < 2:
        return RawFiles([paths] if groups else [], total, None)
    # Folders such as k=1 below a single root make columns, as when Spark reads the root itself.
    base = paths if isinstance(paths, str) and not re.search(r"[*?{\[]", paths) else None
    return RawFiles(list(groups.values()), total, base)


class _HeadReader:
    """Reads the first record of a file as text, through the file systems and codecs of Spark."""

    def __init__(self, spark: SparkSession, sep: str, multi_line: bool):
        self._jvm = spark._jvm
        self._conf = spark._jsc.hadoopConfiguration()
        self._codecs = self._jvm.org.apache.hadoop.io.compress.CompressionCodecFactory(self._conf)
        plain = rf"[^{re.escape(sep)}\r\n]*"
        cell = rf'(?:[ \t]*"(?:[^"]|"")*"{plain}|{plain})' if multi_line else plain
        self._record = re.compile(rf"{cell}(?:{re.escape(sep)}{cell})*")

    def head(self, path: str) -> str:
        """The first record without its line end; empty if the file has none."""
        size = HEAD_BYTES
        while True:
            text, whole = self._begin(path, size)
            text = text.removeprefix("\ufeff").lstrip("\r\n")
            record = self._record.match(text).group()
            if whole or len(record) < len(text):
                return record
            size *= 8

    def _begin(self, path: str, size: int) -> tuple[str, bool]:
        """Up to ``size`` bytes from the start as text, and whether that is all of the file."""
        location = self._jvm.org.apache.hadoop.fs.Path(path)
        stream = location.getFileSystem(self._conf).open(location)
        try:
            codec = self._codecs.getCodec(location)
            plain = codec.createInputStream(stream) if codec else stream
            bounded = self._jvm.org.apache.commons.io.input.BoundedInputStream(plain, size)
            content = self._jvm.org.apache.commons.io.IOUtils.toString(bounded, "UTF-8")
            return content, plain.read() < 0
        finally:
            stream.close()
