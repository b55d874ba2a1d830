"""Row cleaning for refinement."""

from __future__ import annotations

from collections.abc import Collection, Mapping

from pyspark.sql import DataFrame
from pyspark.sql import types as T

from carebase.functions.columns import null_if_missing, number_or_date, quoted

SOURCE_FILE = "source_file"
INGESTED_AT = "ingested_at_utc"


def text_columns(df: DataFrame) -> list[str]:
    return [field.name for field in df.schema if isinstance(field.dataType, T.StringType)]


def standardize_missing(
    df: DataFrame, skip: Collection[str] = (SOURCE_FILE, INGESTED_AT)
) -> DataFrame:
    """Missing-value tokens of text columns become null. One projection, inside codegen."""
    texts = set(text_columns(df)).difference(skip)
    return df.selectExpr(
        *[
            f"{null_if_missing(name)} as {quoted(name)}" if name in texts else quoted(name)
            for name in df.columns
        ]
    )


def clean(
    df: DataFrame,
    types: Mapping[str, str],
    on_bad_value: str,
    bad_cells: str,
    skip: Collection[str] = (SOURCE_FILE, INGESTED_AT),
) -> DataFrame:
    """``standardize_missing``, with the text columns named in ``types`` cast as well.

    Adds a column with the number of cells that did not fit their type; it is 0 throughout
    unless bad cells become null.
    """
    texts = set(text_columns(df)).difference(skip)
    cells, lost = [], []
    for name in df.columns:
        cell = quoted(name)
        if name in texts and name in types:
            cell = number_or_date(name, types[name], on_bad_value)
            lost.append(f"cast({cell} is null and {null_if_missing(name)} is not null as int)")
        elif name in texts:
            cell = null_if_missing(name)
        cells.append(f"{cell} as {quoted(name)}")
    count = " + ".join(lost) if lost and on_bad_value == "null" else "0"
    return df.selectExpr(*cells, f"{count} as {bad_cells}")
