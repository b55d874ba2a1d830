"""Which rows a refined dataset already holds, as a bucketed table of row hashes.

An append run asks it before it writes, so that a file that comes twice adds nothing. The hashes lie
in buckets, as Spark writes bucketed tables; the join with new rows therefore shuffles the new rows
alone, however much is stored. The index is caught up at the start of a run, with the data files that
it does not cover yet. So nothing has to be stored together with the rows: a run that dies after its
rows were written is found by the next one, and rows that were appended without the index are too. If
covered files are gone, or rows are compared by other columns, the index is built anew; so it is when
the data has outgrown its buckets by a factor of ``OUTGROWN``.

A row is known by 128 bits, of which nulls are a part: among 10^12 rows, the chance that any two
different ones agree is about 10^-15.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator, Sequence
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from carebase.datasets import dataset_path
from carebase.functions.columns import quoted
from carebase.session import PARTITION_BYTES, written
from carebase.sources.versions import Version, VersionLog

OUTGROWN = 4
HASHES = ("__h1", "__h2")
_SCHEMA = ", ".join(f"{name} bigint" for name in HASHES)


def row_hashes(columns: Sequence[str]) -> dict[str, str]:
    """Two hashes of the values of ``columns``, as SQL by name; equal for 0.0 and -0.0, and for NaNs."""
    cells = ", ".join(f"{quoted(name)} is null, {quoted(name)}" for name in columns)
    return {name: f"xxhash64('{name}', {cells})" for name in HASHES}


class RowIndex:
    """The index of one dataset, beside it under ``<root>/_rows/<dataset>``."""

    def __init__(self, spark: SparkSession, root: str, dataset: str, columns: Sequence[str]):
        self.spark = spark
        self.data = dataset_path(root, dataset)
        self.columns = sorted(columns)
        self.log = VersionLog(spark, f"{root.rstrip('/')}/_rows/{dataset}")

    def _files(self) -> DataFrame:
        files = self.spark.read.format("binaryFile").load(self.data)
        return files.select(F.col("_metadata.file_path").alias("file"), "length", "path")

    def _covered(self, version: Version) -> DataFrame:
        path = f"{self.log.path}/{version.content['folder']}/files"
        return self.spark.read.schema("file string").parquet(path)

    def catch_up(self) -> Version:
        """Covers all data files. Only those that are not covered yet are read."""
        files = self._files()
        stored = files.agg(F.sum("length")).first()[0] or 0
        partitions = int(self.spark.conf.get("spark.sql.shuffle.partitions"))
        buckets = max(partitions, stored // PARTITION_BYTES + 1)
        version = self.log.latest()
        if version is not None and self._is_stale(version, files, buckets):
            version = self._restart(version, buckets)
        elif version is None:
            version = self._restart(None, buckets)
        fresh = files.join(self._covered(version), "file", "left_anti").select("file", "path")
        fresh = written(fresh, "fresh_files")
        # Names of the files that a run or a few have added; Spark's reader takes them as a list.
        paths = [row.path for row in fresh.select("path").toLocalIterator()]
        if paths:
            rows = self.spark.read.option("basePath", self.data).parquet(*paths)
            hashes = rows.selectExpr(*[f"{sql} as {n}" for n, sql in row_hashes(self.columns).items()])
            with self._table(version) as name:
                hashes.repartition(version.content["buckets"], *HASHES).write.insertInto(name)
            # A run that dies here leaves hashes of stored rows, which come once more: no harm.
            folder = f"{self.log.path}/{version.content['folder']}/files"
            fresh.select("file").write.mode("append").parquet(folder)
        return version

    def _is_stale(self, version: Version, files: DataFrame, buckets: int) -> bool:
        content = version.content
        if content["columns"] != self.columns or buckets > OUTGROWN * content["buckets"]:
            return True
        return not self._covered(version).join(files, "file", "left_anti").isEmpty()

    def _restart(self, version: Version | None, buckets: int) -> Version:
        number = version.number + 1 if version else 1
        content = {"folder": f"index-{number}", "buckets": buckets, "columns": self.columns}
        none = self.spark.createDataFrame([], "file string")
        none.write.mode("overwrite").parquet(f"{self.log.path}/{content['folder']}/files")
        return self.log.commit(version, content)

    @contextmanager
    def _table(self, version: Version) -> Iterator[str]:
        """A name in this session for the bucketed files; they stay when it goes."""
        name = f"carebase_rows_{uuid.uuid4().hex}"
        location = f"{self.log.path}/{version.content['folder']}/rows".replace("'", "\\'")
        hashes = ", ".join(HASHES)
        self.spark.sql(
            f"CREATE TABLE {name} ({_SCHEMA}) USING parquet CLUSTERED BY ({hashes}) "
            f"SORTED BY ({hashes}) INTO {version.content['buckets']} BUCKETS LOCATION '{location}'"
        )
        try:
            yield name
        finally:
            self.spark.sql(f"DROP TABLE {name}")

    @contextmanager
    def marked(self, df: DataFrame, known: str) -> Iterator[DataFrame]:
        """``df`` with a column that is true for rows that are stored and null for others.

        A marker and not an anti join, so that the stage that writes can count both kinds.
        """
        with self._table(self.catch_up()) as name:
            stored = self.spark.table(name).groupBy(*HASHES).agg(F.lit(True).alias(known))
            hashed = df.withColumns({n: F.expr(sql) for n, sql in row_hashes(self.columns).items()})
            yield hashed.join(stored, list(HASHES), "left").drop(*HASHES)
