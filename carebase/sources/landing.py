"""Landing: files copied in parallel under ``<root>/<target path>``, whole or not at all.

Two jobs, with a commit between them:

1. Every task copies its files, block by block, to names of its own in a run's staging folder, and
   lists them in a part of the run's manifest. The commit, on the driver, only names the parts of
   the tasks that counted; what lost or repeated tasks left is named by none.
2. A committed manifest is published: each staged file is renamed to its target, in place of an
   older version. A rename that was done is skipped, so publishing can be repeated after a crash;
   ``land`` first finishes what earlier runs committed.

Neither bytes nor file names pass through the driver, only the name of one part per task. Tasks reach
files through ``pyarrow.fs`` (local and mounted folders, ``s3``, ``gs``, ``hdfs``), with the
credentials of the machine.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterator
from dataclasses import dataclass
from urllib.parse import unquote, urlparse

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceWriter, WriterCommitMessage
from pyspark.sql.types import StructType

from carebase.operators.latest import latest_per_key

STAGING = "_landing"
BLOCK_BYTES = 8 * 2**20
PART_SCHEMA = "file_id string, target_path string, staged string, size long"


def locate(uri: str) -> tuple[fs.FileSystem, str]:
    """File system and path of a URI as Spark writes it, or of a plain path."""
    parsed = urlparse(uri)
    if parsed.scheme in ("", "file"):
        return fs.LocalFileSystem(), unquote(parsed.path) if parsed.scheme else uri
    if parsed.scheme in ("s3a", "s3n"):
        uri = f"s3{uri[len(parsed.scheme):]}"
    return fs.FileSystem.from_uri(uri)


def _join(folder: str, name: str) -> str:
    return f"{folder.rstrip('/')}/{name}"


def copy_file(source: str, root_fs: fs.FileSystem, target: str) -> int:
    """Copies in blocks, so memory does not depend on the file; returns the bytes copied."""
    source_fs, path = locate(source)
    size = 0
    with source_fs.open_input_stream(path) as reader, root_fs.open_output_stream(target) as writer:
        while block := reader.read(BLOCK_BYTES):
            writer.write(block)
            size += len(block)
    return size


@dataclass
class PartNamed(WriterCommitMessage):
    name: str


class LandingWriter(DataSourceWriter):
    """Stages the files of (file_id, path, target_path) rows."""

    def __init__(self, root: str, run: str):
        self.root, self.run = root, run

    def _folder(self) -> tuple[fs.FileSystem, str]:
        root_fs, root = locate(self.root)
        return root_fs, _join(root, f"{STAGING}/{self.run}")

    def write(self, iterator: Iterator[Row]) -> PartNamed:
        root_fs, folder = self._folder()
        attempt = uuid.uuid4().hex
        for name in ("files", "parts"):
            root_fs.create_dir(_join(folder, name), recursive=True)
        part = f"parts/{attempt}.json"
        with root_fs.open_output_stream(_join(folder, part)) as lines:
            for i, row in enumerate(iterator):
                staged = f"files/{attempt}-{i}"
                size = copy_file(row.path, root_fs, _join(folder, staged))
                line = {
                    "file_id": row.file_id,
                    "target_path": row.target_path,
                    "staged": staged,
                    "size": size,
                }
                lines.write(json.dumps(line).encode() + b"\n")
        return PartNamed(part)

    def commit(self, messages: list[PartNamed | None]) -> None:
        root_fs, folder = self._folder()
        root_fs.create_dir(folder, recursive=True)
        parts = sorted(message.name for message in messages if message)
        draft = _join(folder, f"{uuid.uuid4().hex}.draft")
        with root_fs.open_output_stream(draft) as stream:
            stream.write(json.dumps({"parts": parts}).encode())
        root_fs.move(draft, _join(folder, "committed.json"))

    def abort(self, messages: list[PartNamed | None]) -> None:
        root_fs, folder = self._folder()
        if root_fs.get_file_info(folder).type != fs.FileType.NotFound:
            root_fs.delete_dir(folder)


class LandingSource(DataSource):
    """Write-only: ``df.write.format("carebase_landing").option("path", root).option("run", id)``."""

    @classmethod
    def name(cls) -> str:
        return "carebase_landing"

    def writer(self, schema: StructType, overwrite: bool) -> LandingWriter:
        return LandingWriter(self.options["path"], self.options["run"])


def _runs(root: str) -> list[str]:
    """Runs that were staged and not cleared away, in no order."""
    root_fs, path = locate(root)
    found = root_fs.get_file_info(fs.FileSelector(_join(path, STAGING), allow_not_found=True))
    return [info.base_name for info in found if info.type == fs.FileType.Directory]


def _committed_parts(root: str, run: str) -> list[str] | None:
    root_fs, path = locate(root)
    manifest = _join(path, f"{STAGING}/{run}/committed.json")
    if root_fs.get_file_info(manifest).type == fs.FileType.NotFound:
        return None
    with root_fs.open_input_stream(manifest) as stream:
        return json.loads(stream.read())["parts"]


def _publish(root: str, run: str):
    """A task's part of publishing: renames, and says what it did."""

    def rename(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        root_fs, path = locate(root)
        folder = _join(path, f"{STAGING}/{run}")
        for batch in batches:
            done = []
            for row in batch.to_pylist():
                staged, target = _join(folder, row["staged"]), _join(path, row["target_path"])
                root_fs.create_dir(target.rpartition("/")[0], recursive=True)
                there = root_fs.get_file_info(staged).type != fs.FileType.NotFound
                if there:
                    root_fs.move(staged, target)
                elif root_fs.get_file_info(target).size != row["size"]:
                    raise FileNotFoundError(f"neither staged nor landed: {row['target_path']}")
                done.append(row["size"])
            yield pa.RecordBatch.from_pydict({"size": pa.array(done, pa.int64())})

    return rename


def publish(spark: SparkSession, root: str, run: str) -> tuple[int, int]:
    """Puts the files of a committed run in their places; returns their number and bytes.

    The staging folder goes last. A run that was never committed is only cleared away.
    """
    parts = _committed_parts(root, run)
    total = (0, 0)
    if parts:
        folder = _join(root, f"{STAGING}/{run}")
        listed = spark.read.schema(PART_SCHEMA).json([_join(folder, part) for part in parts])
        moved = listed.mapInArrow(_publish(root, run), "size long")
        total = tuple(moved.agg(F.count("*"), F.coalesce(F.sum("size"), F.lit(0))).first())
    root_fs, path = locate(root)
    root_fs.delete_dir(_join(path, f"{STAGING}/{run}"))
    return total


def finish_earlier_runs(spark: SparkSession, root: str) -> None:
    """Publishes what crashed runs had committed, and clears away what they had not.

    One ingest at a time: the staging of a run that is still copying would be cleared away too.
    """
    for run in sorted(_runs(root)):
        publish(spark, root, run)


def land(files: DataFrame, root: str, run: str | None = None) -> tuple[int, int]:
    """Copies files to ``<root>/<target_path>``; returns how many and their bytes.

    ``files`` is (file_id, path, target_path, modified_time). Of several files with one target the
    newest is landed, then the one with the last id. Files of any size take one task each at a time;
    many small ones share a task.
    """
    spark = files.sparkSession
    finish_earlier_runs(spark, root)
    run = run or f"{len(_runs(root)):04d}-{uuid.uuid4().hex}"
    newest = latest_per_key(files, ["target_path"], "modified_time", ["file_id desc"])
    spark.dataSource.register(LandingSource)
    (
        newest.select("file_id", "path", "target_path")
        .repartition("target_path")
        .write.format(LandingSource.name())
        .mode("append")
        .option("path", root)
        .option("run", run)
        .save()
    )
    return publish(spark, root, run)
