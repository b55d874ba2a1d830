"""Incremental run: listing and state in, refined datasets and new state out."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import UTC, datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from carebase.datasets import UNMAPPED, dataset_path
from carebase.operators.changes import PENDING, detect_changes, ingest_counts, stale_datasets
from carebase.operators.routing import route_files
from carebase.operators.state import read_state, record_state, state_rows
from carebase.plans.refine import (
    PROCESSED,
    RefineOptions,
    refine_sources,
    results_table,
    utc_now,
)
from carebase.session import written
from carebase.sources.landing import finish_earlier_runs, land


@dataclass(frozen=True)
class IngestRun:
    """``counts``: processed, skipped, unmapped. ``results``: one row per refined dataset."""

    counts: DataFrame
    results: DataFrame


def dataset_files(routed: DataFrame, dataset: str) -> list[str]:
    """Paths of one dataset's files, in name order, so that the first header is stable.

    These are file names, not data: Spark's reader takes them as a list, and its own file
    index keeps the same list on the driver.
    """
    files = routed.filter(F.col("dataset") == dataset).select("path").orderBy("path")
    return [row.path for row in files.toLocalIterator()]


def changed_dataset_files(changes: DataFrame, dataset: str) -> list[str]:
    """Paths of the new and changed files of one dataset."""
    return dataset_files(changes.filter(PENDING), dataset)


def ingest(
    spark: SparkSession,
    listing: DataFrame,
    state_path: str,
    refined_root: str,
    *,
    landing_root: str | None = None,
    bucket: str = "",
    prefix: str = "",
    run_ts: str | None = None,
    fail_on_error: bool = True,
    options: RefineOptions | None = None,
) -> IngestRun:
    """Lands and refines every dataset that has a new or changed CSV in ``listing``.

    ``listing`` has a ``path`` column. With a ``landing_root``, new and changed files are copied
    to ``<landing_root>/<prefix>/<dataset>/`` first, those without a rule to ``_unmapped`` there,
    in place of older versions; mode ``overwrite`` then rebuilds a dataset from its landed folder,
    so rows of a file that has left the listing stay; of a partitioned dataset only the partitions
    that new and changed files touch are rewritten. Without a landing root, files are read where they are,
    no file is copied, and ``overwrite`` rebuilds a dataset from the files of the listing. With mode
    ``append`` only the rows of new and changed files are added.

    A file enters the state when its dataset has been written, so a failed dataset is tried again
    by the next run. Files without a rule enter it at once.
    """
    options = options or RefineOptions()
    run_ts = run_ts or utc_now()
    # Stored, because the folder may change while the run reads this table several times.
    changes = written(
        detect_changes(route_files(listing, prefix), read_state(spark, state_path)), "changes"
    )
    stale = [row.dataset for row in stale_datasets(changes).orderBy("dataset").collect()]
    if landing_root is not None:
        if changes.where(PENDING).isEmpty():
            finish_earlier_runs(spark, landing_root)
        else:
            land(changes.where(PENDING), landing_root)
        landed_path = F.concat(F.lit(f"{landing_root.rstrip('/')}/"), "target_path")
        changes = changes.withColumn("path", landed_path)
    if options.mode == "append":
        sources = {dataset: changed_dataset_files(changes, dataset) for dataset in stale}
    elif landing_root is not None:
        folder = dataset_path(landing_root, prefix.strip("/")).rstrip("/")
        sources = {dataset: dataset_path(folder, dataset) for dataset in stale}
    else:
        sources = {dataset: dataset_files(changes, dataset) for dataset in stale}
    by_parts = [dataset for dataset in stale if dataset in options.partition and landing_root]
    changed = {dataset: changed_dataset_files(changes, dataset) for dataset in by_parts}
    results = refine_sources(spark, sources, refined_root, run_ts, options, changed)

    landed = [row["dataset"] for row in results if row["status"] == PROCESSED]
    done = changes.where(PENDING).where(F.col("dataset").isin(UNMAPPED, *landed))
    if not done.isEmpty():
        record_state(state_rows(done, bucket, _utc_without_zone(run_ts)), state_path)
    counts = ingest_counts(changes, (UNMAPPED, *landed))
    return IngestRun(counts, results_table(spark, results, fail_on_error))


def _utc_without_zone(run_ts: str) -> str:
    moment = datetime.fromisoformat(run_ts)
    return (moment.astimezone(UTC) if moment.tzinfo else moment).replace(tzinfo=None).isoformat()
