"""File names to datasets."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from carebase.datasets import ROUTES, UNMAPPED


def csv_files(listing: DataFrame) -> DataFrame:
    return listing.where("lower(file_name) like '%.csv'")


def dataset_of(file_name: str = "file_name") -> str:
    """Dataset of the first matching rule. One CASE expression, evaluated top down."""
    rules = " ".join(
        f"when {file_name} rlike r'(?iu){pattern}' then '{dataset}'"
        for dataset, pattern in ROUTES.items()
    )
    return f"case {rules} else '{UNMAPPED}' end"


def route_files(listing: DataFrame, prefix: str = "") -> DataFrame:
    """Adds ``dataset``, ``target_path`` and ``is_unmapped`` to every CSV of a listing."""
    folder = prefix.strip("/")
    parts = [F.lit(folder)] * bool(folder) + [F.col("dataset"), F.col("file_name")]
    return (
        csv_files(listing)
        .selectExpr("*", f"{dataset_of()} as dataset")
        .withColumns(
            {
                "target_path": F.concat_ws("/", *parts),
                "is_unmapped": F.col("dataset") == UNMAPPED,
            }
        )
    )


def name_clashes(routed: DataFrame) -> DataFrame:
    """Target paths that more than one file of the listing would take."""
    return routed.groupBy("target_path").agg(F.expr("count(*) as files")).where("files > 1")
