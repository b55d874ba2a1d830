"""File listing as a table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def list_files(spark: SparkSession, folder: str) -> DataFrame:
    """One row per file of a folder, with the file's path as its id.

    Only file attributes are selected, so Spark prunes the content from the scan and
    opens no file. Times are UTC without zone.
    """
    files = spark.read.format("binaryFile").load(folder)
    return files.select(
        F.col("path").alias("file_id"),
        F.element_at(F.split("path", "/"), -1).alias("file_name"),
        F.lit(None).cast("string").alias("mime_type"),
        F.convert_timezone(
            F.current_timezone(), F.lit("UTC"), F.col("modificationTime").cast("timestamp_ntz")
        ).alias("modified_time"),
        F.col("length").alias("size"),
        F.col("path"),
    )
