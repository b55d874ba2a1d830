"""Newest row per key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

from carebase.functions.columns import quoted

_RANK = "__rank"


def latest_per_key(
    df: DataFrame, keys: Sequence[str], newest: str, tie_break: Sequence[str] = ()
) -> DataFrame:
    """The row with the greatest ``newest`` for each key; nulls count as oldest.

    ``tie_break`` holds further sort terms, such as ``"row_id desc"``; without it any one
    of equally new rows may be returned. Spark plans the rank filter as a group limit in
    front of the shuffle, so every task sends at most one row per key and a key that fills
    a third of the table does no harm.
    """
    order = ", ".join([f"{quoted(newest)} desc nulls last", *tie_break])
    partition = ", ".join(map(quoted, keys))
    rank = f"row_number() over (partition by {partition} order by {order}) as {_RANK}"
    return df.selectExpr("*", rank).where(f"{_RANK} = 1").drop(_RANK)
