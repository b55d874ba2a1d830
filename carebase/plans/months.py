"""Refined tables in partitions, of which a run rewrites only those that its files touch."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from carebase.datasets import dataset_path
from carebase.functions.columns import quoted
from carebase.operators.cleaning import SOURCE_FILE
from carebase.session import written


@dataclass(frozen=True)
class Partitioning:
    """A partition column and the SQL expression that gives its value."""

    column: str
    expression: str


_SPREAD = "__spread"

WORK_MONTH = Partitioning("work_month", "workdate div 100")


def in_partitions(column: str, values: Sequence[int | None]) -> Column:
    """A filter on the partition column, which Spark applies to folders; null is one of the values."""
    condition = F.col(quoted(column)).isin([value for value in values if value is not None])
    return condition | F.col(quoted(column)).isNull() if None in values else condition


def partition_folder(column: str, value: int | None) -> str:
    return f"{column}={'__HIVE_DEFAULT_PARTITION__' if value is None else value}"


def with_partition(df: DataFrame, partitioning: Partitioning) -> DataFrame:
    """``df`` with the partition column last, as Spark reads it back."""
    value = F.expr(f"cast({partitioning.expression} as int)")
    return df.withColumn(partitioning.column, value)


def dealt_out(df: DataFrame, partitioning: Partitioning) -> DataFrame:
    """``df`` by partition and a hash of the row, so that many tasks write a large partition.

    Adaptive execution merges the small ones and cuts those of more than its advisory size.
    """
    spread = F.pmod(F.xxhash64(*(quoted(name) for name in df.columns)), F.lit(64))
    spread_out = df.withColumn(_SPREAD, spread).hint("rebalance", F.col(quoted(partitioning.column)), F.col(_SPREAD))
    return spread_out.drop(_SPREAD)


def replace_files(
    spark: SparkSession,
    rows: DataFrame,
    files: DataFrame,
    refined_root: str,
    dataset: str,
    partitioning: Partitioning,
) -> list[int | None]:
    """Puts the refined ``rows`` of new and changed files in place of the older rows of these files.

    ``rows`` has the columns of the stored table; ``files`` is (source_file). Only partitions that
    have or had rows of these files are read and rewritten; they are returned, in order. Their other
    rows are kept as they are stored, so no other file is read again. That is right as long as rows
    of different files are never merged, which holds when the source file is part of what makes
    rows equal.

    The new partitions are complete in the scratch folder before the first one is replaced. A run
    that dies in between can be repeated: it finds the same files to be new or changed.
    """
    path = dataset_path(refined_root, dataset)
    column = partitioning.column
    stored = spark.read.parquet(path)
    # File names, sent to all tasks: a join by shuffle would bring the rows of a file into one task.
    named = F.broadcast(files.select(F.col(SOURCE_FILE)).distinct())
    rows = written(with_partition(rows, partitioning), "months_new")
    before = stored.join(named, SOURCE_FILE, "left_semi").select(column)
    # One row per partition, so a few hundred for months.
    months = [row[0] for row in rows.select(column).union(before).distinct().collect()]
    if not months:
        return []
    kept = stored.where(in_partitions(column, months)).join(named, SOURCE_FILE, "left_anti")
    renewed = written(kept.select(*stored.columns).unionByName(rows.select(*stored.columns)), "months")
    writer = dealt_out(renewed, partitioning).write.mode("overwrite").partitionBy(column)
    writer.option("partitionOverwriteMode", "dynamic").parquet(path)
    left = {row[0] for row in renewed.select(column).distinct().collect()}
    _drop_partitions(spark, path, column, [month for month in months if month not in left])
    return sorted(months, key=lambda month: (month is None, month))


def _drop_partitions(spark: SparkSession, path: str, column: str, months: list[int | None]) -> None:
    """Deletes partitions that have lost their last row."""
    jvm = spark._jvm
    for month in months:
        folder = jvm.org.apache.hadoop.fs.Path(f"{path}/{partition_folder(column, month)}")
        folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)
