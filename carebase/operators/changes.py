"""Which files of a listing are new or newer than the ingest state."""

from __future__ import annotations

from collections.abc import Collection

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from carebase.datasets import UNMAPPED

PENDING = "action in ('new', 'changed')"


def detect_changes(routed: DataFrame, state: DataFrame) -> DataFrame:
    """Adds ``action``: ``new``, ``changed`` or ``unchanged``.

    A file without a time, or whose state has none, counts as changed: better to read it
    once too often. ``state`` has one row per ``file_id``.
    """
    known = state.selectExpr("file_id", "modified_time as seen_time", "true as is_known")
    action = """
        case when is_known is null then 'new'
             when modified_time is null or seen_time is null or modified_time > seen_time
             then 'changed'
             else 'unchanged' end as action"""
    return routed.join(known, "file_id", "left").selectExpr(
        *[f"`{name}`" for name in routed.columns], action
    )


def changed_files(routed: DataFrame, state: DataFrame) -> DataFrame:
    return detect_changes(routed, state).where(PENDING)


def ingest_counts(changes: DataFrame, done: Collection[str] | None = None) -> DataFrame:
    """One row: CSV files processed, CSV files left alone, and processed ones without a rule.

    ``done`` are the datasets that were written, all by default. Pending files of other ones
    are in no count.
    """
    written = F.lit(True) if done is None else F.col("dataset").isin(*done)
    return changes.agg(
        F.count_if(F.expr(PENDING) & written).alias("processed"),
        F.expr(f"count_if(not {PENDING}) as skipped"),
        F.expr(f"count_if({PENDING} and dataset = '{UNMAPPED}') as unmapped"),
    )


def stale_datasets(changes: DataFrame) -> DataFrame:
    """Known datasets with a new or changed file. No row means nothing needs refining."""
    return changes.where(f"{PENDING} and dataset <> '{UNMAPPED}'").select("dataset").distinct()
