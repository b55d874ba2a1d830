"""Exact-duplicate removal with counts."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def drop_duplicates(df: DataFrame, subset: Sequence[str] | None = None) -> DataFrame:
    """One of each group of equal rows; ``subset`` limits the comparison to some columns."""
    return df.dropDuplicates(list(subset) if subset else None)


def count_copies(
    df: DataFrame,
    copies: str = "copies",
    aside: Sequence[str] = (),
    extra: Mapping[str, str] | None = None,
) -> DataFrame:
    """One row per distinct row, with the number of rows it stands for.

    Columns in ``aside`` do not take part in the comparison; ``extra`` adds aggregates.
    Equal rows are combined before the shuffle, so one row repeated a billion times
    reaches the reducer as one row per task.
    """
    keys = [name for name in df.columns if name not in aside]
    aggregates = {copies: "count(*)", **(extra or {})}
    return df.groupBy(*keys).agg(*[F.expr(f"{sql} as {name}") for name, sql in aggregates.items()])


def dedupe_report(df: DataFrame) -> DataFrame:
    """One row: rows in, rows left and rows dropped. The input is read once."""
    totals = count_copies(df).agg(
        F.expr("coalesce(sum(copies), 0) as rows_in"), F.expr("count(*) as rows_out")
    )
    return totals.selectExpr("rows_in", "rows_out", "rows_in - rows_out as dropped")
