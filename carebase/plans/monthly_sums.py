"""Monthly sums kept beside the written views; a refresh renews those of changed months only.

The refined staffing table lies in partitions by month. The sums of a partition are kept with a
fingerprint of the partition's files, so a refresh finds by listing, whoever has rewritten it, what has
changed since; it reads the facts of those partitions and of no other. Sums are partial results: rows
of one facility and month that come from several partitions are added up when they are read.

Sums are written to a folder of their own and then named by a new version (``sources/versions.py``). A
refresh that dies before that changes nothing for readers, and is done again by the next one. Of two
refreshes at a time, the later to commit fails with ``VersionConflict``.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from carebase.functions.columns import quoted
from carebase.operators.rollup import facility_months, merged_months, month_recipe
from carebase.plans.months import (
    WORK_MONTH,
    Partitioning,
    dealt_out,
    in_partitions,
    partition_folder,
)
from carebase.sources.versions import Version, VersionConflict, VersionLog

KEPT_VERSIONS = 2


def partition_files(spark: SparkSession, path: str, column: str) -> dict[int | None, str]:
    """A fingerprint of names, sizes and times of the files of each partition under ``path``.

    The files are listed, not opened. One row per partition comes to the driver.
    """
    files = spark.read.format("binaryFile").load(path)
    if column not in files.columns:
        raise ValueError(f"{path} is not stored in partitions by {column}")
    name = F.element_at(F.split("path", "/"), -1)
    each = F.xxhash64(name, "length", "modificationTime")
    grouped = files.groupBy(F.col(quoted(column)).cast("int").alias("partition")).agg(
        F.count("*").alias("n"),
        F.bit_xor(each).alias("hash"),
        F.sum("length").alias("bytes"),
    )
    return {row.partition: f"{row.n}:{row.bytes}:{row.hash}" for row in grouped.collect()}


class MonthlySums:
    """The sums stored under a path, for a staffing table stored under another."""

    def __init__(
        self,
        spark: SparkSession,
        path: str,
        staffing_path: str,
        partitioning: Partitioning = WORK_MONTH,
    ):
        self.spark = spark
        self.staffing_path = staffing_path
        self.partitioning = partitioning
        self.log = VersionLog(spark, path)

    def _sums(self, staffing: DataFrame) -> DataFrame:
        return facility_months(staffing, by=(self.partitioning.column,))

    def _known(self, version: Version | None) -> dict[str, dict]:
        """What is stored per partition; nothing if it was summed up in another way."""
        content = version.content if version else {}
        return content["partitions"] if content.get("recipe") == month_recipe() else {}

    def refresh(self) -> list[int | None]:
        """Renews the sums of the partitions whose files have changed, and returns these in order.

        Partitions that are gone lose their sums; they are returned too.
        """
        column, version = self.partitioning.column, self.log.latest()
        known = self._known(version)
        # Before the facts are read: what is rewritten in between is found again next time.
        files = partition_files(self.spark, self.staffing_path, column)
        found = {partition_folder(column, value): value for value in files}
        renewed = {
            name: value
            for name, value in found.items()
            if known.get(name, {}).get("files") != files[value]
        }
        gone = {name: known[name]["value"] for name in known.keys() - found.keys()}
        if known and not renewed and not gone:
            return []
        folder = f"sums-{uuid.uuid4().hex}"
        written = self._write(folder, list(renewed.values())) if renewed else set()
        partitions = {name: known[name] for name in found.keys() - renewed.keys()}
        for name, value in renewed.items():
            stored = folder if name in written else None
            partitions[name] = {"value": value, "files": files[value], "folder": stored}
        try:
            self.log.commit(version, {"recipe": month_recipe(), "partitions": partitions})
        except VersionConflict:
            self.log.delete_data(folder)
            raise
        self._clean_up()
        touched = {*renewed.values(), *gone.values()}
        return sorted(touched, key=lambda value: (value is None, value))

    def _write(self, folder: str, values: list[int | None]) -> set[str]:
        """Stores the sums of some partitions; returns the folders of those that have rows."""
        column = self.partitioning.column
        staffing = self.spark.read.parquet(self.staffing_path)
        sums = self._sums(staffing.where(in_partitions(column, values)))
        writer = dealt_out(sums, self.partitioning).write.partitionBy(column)
        writer.parquet(f"{self.log.path}/{folder}")
        return set(self.log.data_folders(folder))

    def read(self) -> DataFrame:
        """Sums per facility, state and month, as ``facility_months`` gives them for all facts."""
        staffing = self.spark.read.parquet(self.staffing_path)
        schema = self._sums(staffing).drop(self.partitioning.column).schema
        paths = [
            f"{self.log.path}/{stored['folder']}/{name}"
            for name, stored in sorted(self._known(self.log.latest()).items())
            if stored["folder"]
        ]
        if not paths:
            return self.spark.createDataFrame([], schema)
        return merged_months(self.spark.read.schema(schema).parquet(*paths))

    def _clean_up(self) -> None:
        """Deletes folders that only forgotten versions named."""

        def named(versions: list[Version]) -> set[str | None]:
            return {s["folder"] for v in versions for s in v.content["partitions"].values()}

        dropped = named(self.log.forget(KEPT_VERSIONS))
        kept = named([self.log.read(number) for number in self.log.numbers()])
        for folder in dropped - kept - {None}:
            self.log.delete_data(folder)
