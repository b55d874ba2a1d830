"""Refined Parquet: one folder per dataset."""

from __future__ import annotations

from collections.abc import Collection, Iterable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from carebase.datasets import dataset_path
from carebase.sources.raw import is_missing_source

WRITE_MODES = ("overwrite", "append")


def check_write_mode(mode: str) -> str:
    mode = mode.lower()
    if mode not in WRITE_MODES:
        raise ValueError(f"write mode must be one of {WRITE_MODES}, not {mode!r}")
    return mode


def write_refined(
    df: DataFrame,
    root: str,
    dataset: str,
    mode: str = "overwrite",
    partition_by: str | None = None,
) -> str:
    """Writes a dataset; see ``like_stored`` for what is appended."""
    path = dataset_path(root, dataset)
    mode = check_write_mode(mode)
    if mode == "append":
        df = like_stored(df, path)
    writer = df.write.mode(mode).option("partitionOverwriteMode", "static")
    (writer.partitionBy(partition_by) if partition_by else writer).parquet(path)
    return path


def like_stored(df: DataFrame, path: str, aside: Collection[str] = ()) -> DataFrame:
    """``df`` with the columns stored at ``path``, if there are any; those it lacks are null.

    Columns of other types than the stored ones are refused, and so are new ones: readers take
    the columns of a table from one of its files. Those in ``aside`` are not compared.
    """
    try:
        stored = dict(df.sparkSession.read.parquet(path).dtypes)
    except AnalysisException as error:
        if is_missing_source(error):
            return df
        raise
    changed = [name for name, kind in df.dtypes if stored.get(name, kind) != kind]
    if changed:
        raise ValueError(f"columns of other types than those stored: {', '.join(changed)}")
    new = [name for name in df.columns if name not in stored and name not in aside]
    if new:
        raise ValueError(f"columns that are not stored, overwrite to add them: {', '.join(new)}")
    lacking = {name: F.lit(None).cast(kind) for name, kind in stored.items() if name not in df.columns}
    return df.withColumns(lacking) if lacking else df


def is_stored(spark: SparkSession, root: str, dataset: str) -> bool:
    """Whether a dataset is stored at all."""
    try:
        spark.read.parquet(dataset_path(root, dataset))
    except AnalysisException as error:
        if is_missing_source(error):
            return False
        raise
    return True


def read_refined(spark: SparkSession, root: str, dataset: str) -> DataFrame:
    return spark.read.parquet(dataset_path(root, dataset))


def register_refined(spark: SparkSession, root: str, datasets: Iterable[str]) -> None:
    """Make refined datasets available to SQL under their own names."""
    for dataset in datasets:
        read_refined(spark, root, dataset).createOrReplaceTempView(dataset)
