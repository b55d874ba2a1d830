"""Ingest state: the last processed version of each file.

The state is a snapshot plus a short log. Recording files adds one folder to the log; after
``FOLD_AFTER`` of them the log is folded into a new snapshot. Which folders make up the state is
said by its newest version (see ``sources/versions.py``), which is the only thing that changes in
place. A reader keeps to the version it began with, and a job that dies between two steps leaves the
older version as it was.
"""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from carebase.operators.latest import latest_per_key
from carebase.sources.versions import Version, VersionConflict, VersionLog

STATE_SCHEMA = (
    "file_id string, file_name string, modified_time timestamp_ntz, bucket string, key string, "
    "dataset_folder string, last_processed_at timestamp_ntz"
)

FOLD_AFTER = 16
# Versions that stay readable for jobs that began before the newest one.
KEPT_VERSIONS = 32
ATTEMPTS = 5


def state_rows(processed: DataFrame, bucket: str, processed_at: str) -> DataFrame:
    """State rows for routed files that have just been processed."""
    return processed.select(
        "file_id",
        "file_name",
        "modified_time",
        F.lit(bucket).alias("bucket"),
        F.col("target_path").alias("key"),
        F.col("dataset").alias("dataset_folder"),
        F.lit(processed_at).cast("timestamp_ntz").alias("last_processed_at"),
    )


def upsert_state(state: DataFrame, done: DataFrame) -> DataFrame:
    """``state`` with the rows of ``done`` added or put in place of older ones."""
    return state.join(done, "file_id", "left_anti").unionByName(done)


def last_of_each_file(done: DataFrame) -> DataFrame:
    """One row per file: the last one processed, the newest version of the file among equals."""
    return latest_per_key(
        done, ["file_id"], "last_processed_at", ["modified_time desc nulls last"]
    )


class StateTable:
    """The state under a path, at its newest version when the object was made."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark = spark
        self.log = VersionLog(spark, path)
        self.version: Version | None = self.log.latest()

    @property
    def folders(self) -> tuple[str | None, list[str]]:
        content = self.version.content if self.version else {}
        return content.get("snapshot"), content.get("log", [])

    def _folder(self, name: str) -> DataFrame:
        return self.spark.read.schema(STATE_SCHEMA).parquet(f"{self.log.path}/{name}")

    def read(self) -> DataFrame:
        """One row per file; empty before the first run.

        The parts of the log are applied in their order, so of two versions of a file the one
        recorded later wins, whatever its times say.
        """
        snapshot, log = self.folders
        state = self._folder(snapshot) if snapshot else None
        if not log:
            return state or self.spark.createDataFrame([], STATE_SCHEMA)
        parts = [self._folder(name).withColumn("_part", F.lit(i)) for i, name in enumerate(log)]
        recorded = latest_per_key(reduce(DataFrame.unionByName, parts), ["file_id"], "_part")
        recorded = recorded.drop("_part")
        return upsert_state(state, recorded) if snapshot else recorded

    def _store(self, rows: DataFrame, kind: str) -> str:
        name = f"{kind}-{uuid.uuid4().hex}"
        rows.write.parquet(f"{self.log.path}/{name}")
        return name

    def record(self, done: DataFrame) -> None:
        """Adds processed files; folds the log when it has grown long.

        The rows are stored before the version that names them. If another job has committed a
        version meanwhile, this part is added behind that one.
        """
        part = self._store(last_of_each_file(done), "log")
        for _ in range(ATTEMPTS):
            snapshot, log = self.folders
            try:
                self.version = self.log.commit(
                    self.version, {"snapshot": snapshot, "log": [*log, part]}
                )
                break
            except VersionConflict:
                self.version = self.log.latest()
        else:
            raise VersionConflict(f"{self.log.path}: gave up after {ATTEMPTS} attempts")
        if len(self.folders[1]) >= FOLD_AFTER:
            self.fold()

    def fold(self) -> None:
        """Writes the state as one snapshot. If another job was faster, its version stays."""
        snapshot = self._store(self.read(), "snapshot")
        try:
            self.version = self.log.commit(self.version, {"snapshot": snapshot, "log": []})
        except VersionConflict:
            self.log.delete_data(snapshot)
            self.version = self.log.latest()

    def clean_up(self, keep: int = KEPT_VERSIONS) -> None:
        """Forgets all but the last ``keep`` versions, and deletes the folders only they named."""
        dropped = self.log.forget(keep)
        named = [self.log.read(number).content for number in self.log.numbers()]
        alive = {name for content in named for name in (content["snapshot"], *content["log"])}
        gone = {name for v in dropped for name in (v.content["snapshot"], *v.content["log"])}
        for name in gone - alive - {None}:
            self.log.delete_data(name)


def read_state(spark: SparkSession, path: str) -> DataFrame:
    """One row per file, the last one recorded; empty before the first run."""
    return StateTable(spark, path).read()


def record_state(done: DataFrame, path: str) -> None:
    """Adds processed files to the state under ``path``."""
    table = StateTable(done.sparkSession, path)
    table.record(done)
    table.clean_up()
