"""Raw CSV to refined Parquet."""

from __future__ import annotations

import logging
from collections.abc import Iterable, Iterator, Mapping
from contextlib import contextmanager
from dataclasses import dataclass, field
from datetime import UTC, datetime
from functools import partial

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from carebase.datasets import DECLARED_TYPES, dataset_path, pick_datasets
from carebase.functions.columns import check_bad_value_mode
from carebase.functions.names import normalize_names
from carebase.operators.cleaning import INGESTED_AT, SOURCE_FILE, clean
from carebase.operators.dedupe import count_copies
from carebase.plans.months import Partitioning, dealt_out, replace_files, with_partition
from carebase.session import shuffle_partitions_for, side_by_side
from carebase.sources.inference import SchemaRegistry, as_types, stored_as_text, types_of
from carebase.sources.raw import (
    NoColumns,
    header_groups,
    is_missing_source,
    scan_csv,
    united,
    with_file,
)
from carebase.sources.refined import (
    check_write_mode,
    is_stored,
    like_stored,
    read_refined,
    write_refined,
)
from carebase.sources.row_index import RowIndex

logger = logging.getLogger(__name__)

PROCESSED, SKIPPED, FAILED = "processed", "skipped_missing", "failed"

RESULT_SCHEMA = (
    "dataset string, status string, reason string, refined_path string, "
    "rows_in bigint, rows_out bigint, duplicates bigint, bad_cells bigint"
)

_COPIES, _BAD_CELLS, _FILE, _KNOWN = "__copies", "__bad_cells", "__file", "__known"


class RefineError(RuntimeError):
    """At least one dataset failed; the others are done. ``results`` has them all."""

    def __init__(self, results: list[dict]):
        self.results = results
        failed = {row["dataset"]: row["reason"] for row in results if row["status"] == FAILED}
        super().__init__(f"failed datasets: {failed}")


@dataclass(frozen=True)
class RefineOptions:
    """How raw files are read and cleaned; the defaults fit the published files.

    ``types``: column types per dataset, by normalised name. A dataset listed here is read
    as text and cast by name. Of any other one the text is stored in one pass, which finds the
    types, and then cast; they are kept in a registry, and ``reason`` tells which have changed.
    ``single_line``: datasets known to have no line breaks inside fields and one kind of line
    end, so that their files can be split. Files of other datasets take one task each.
    ``ignore_lineage``: rows equal but for their source file are duplicates too. By default
    they are not.
    ``on_bad_value``: ``raise`` fails the dataset when a declared type does not fit,
    ``null`` drops the cell and counts it in ``bad_cells``.
    ``skip_stored``: in append mode, rows that the dataset already holds are not added but count as
    duplicates. The run time plays no part in that, nor does the source file with ``ignore_lineage``.
    ``partition``: how the refined rows of a dataset are laid out, for those that shall be. When
    files change, an incremental run then rewrites only the partitions that these files touch.
    ``at_once``: how many datasets are refined at a time. Small ones leave most of a cluster idle.
    """

    header: bool = True
    sep: str = ","
    mode: str = "overwrite"
    skip_missing: bool = True
    ignore_lineage: bool = False
    on_bad_value: str = "raise"
    types: Mapping[str, Mapping[str, str]] = field(default_factory=lambda: DECLARED_TYPES)
    single_line: frozenset[str] = frozenset()
    partition: Mapping[str, Partitioning] = field(default_factory=dict)
    skip_stored: bool = False
    at_once: int = 4

    def __post_init__(self) -> None:
        if self.at_once < 1:
            raise ValueError(f"at_once must be 1 or more, not {self.at_once}")
        object.__setattr__(self, "mode", check_write_mode(self.mode))
        check_bad_value_mode(self.on_bad_value)


def utc_now() -> str:
    return datetime.now(UTC).isoformat()


def read_raw(
    spark: SparkSession, paths: str | list[str], dataset: str, options: RefineOptions
) -> tuple[DataFrame, int]:
    """The rows of all files as text, with the file of each row as the last column; and their bytes.

    Files of equal headers are read together, and the groups are united by normalised name.
    """
    reading = {
        "header": options.header,
        "sep": options.sep,
        "multi_line": dataset not in options.single_line,
    }
    files = header_groups(spark, paths, **reading)
    more = {"base_path": files.base_path} if files.base_path else {}
    parts = [scan_csv(spark, group, infer=False, **reading, **more) for group in files.groups]
    parts = [with_file(df, _FILE) for df in parts if df.columns]
    if not parts:
        raise NoColumns("no columns")
    return united(parts, _FILE), files.total


def refine(
    raw: DataFrame,
    run_ts: str,
    types: Mapping[str, str] | None = None,
    *,
    ignore_lineage: bool = False,
    on_bad_value: str = "raise",
) -> DataFrame:
    """Cleaned distinct rows of ``raw``, plus two count columns for the report.

    The last column of ``raw`` is the file of each row. The lineage columns are named together
    with the others, so they get a number when the file has columns of their names. The run time
    is the same for all rows and is added after the shuffle.
    """
    headers = [*raw.columns[:-1], SOURCE_FILE, INGESTED_AT]
    *names, ingested_at = normalize_names(headers)
    source_file = names[-1]
    df = raw.toDF(*names)
    df = clean(df, types or {}, on_bad_value, _BAD_CELLS, skip=(source_file,))

    aside = [_BAD_CELLS]
    extra = {_BAD_CELLS: f"sum({_BAD_CELLS})"}
    if ignore_lineage:
        aside.append(source_file)
        extra[source_file] = f"min({source_file})"
    distinct = count_copies(df, _COPIES, aside, extra)
    return distinct.select(
        *names, F.lit(run_ts).alias(ingested_at), F.col(_COPIES), F.col(_BAD_CELLS)
    )


@contextmanager
def _marked(
    df: DataFrame, refined_root: str, dataset: str, options: RefineOptions
) -> Iterator[DataFrame]:
    """Refined rows with a column that tells those to be left out, because they are stored."""
    spark, none = df.sparkSession, df.withColumn(_KNOWN, F.lit(False))
    if not options.skip_stored or options.mode != "append":
        yield none
    elif not is_stored(spark, refined_root, dataset):
        yield none
    else:
        *names, source_file, ingested_at, _, _ = df.columns
        partitioning = options.partition.get(dataset)
        apart = {ingested_at, partitioning.column if partitioning else ingested_at}
        if options.ignore_lineage:
            apart.add(source_file)
        df = like_stored(df, dataset_path(refined_root, dataset), aside=(_COPIES, _BAD_CELLS))
        columns = [n for n in df.columns if n not in apart and n not in (_COPIES, _BAD_CELLS)]
        with RowIndex(spark, refined_root, dataset, columns).marked(df, _KNOWN) as marked:
            yield marked.withColumn(_KNOWN, F.coalesce(_KNOWN, F.lit(False)))


def refine_paths(
    spark: SparkSession,
    paths: str | list[str],
    dataset: str,
    refined_root: str,
    run_ts: str,
    options: RefineOptions,
    changed: bool = False,
) -> dict:
    """Refines one dataset and returns its result row. Errors are raised.

    With ``changed``, ``paths`` are the new and changed files of a partitioned dataset, and only
    their rows are put in place of older ones.
    """
    types = options.types.get(dataset)
    partitioning = options.partition.get(dataset)
    raw, total = read_raw(spark, paths, dataset, options)
    registry, appending = SchemaRegistry(spark, refined_root, dataset), options.mode == "append"
    if types is None:
        stored, bits = stored_as_text(raw)
        known = registry.bits() if appending else {}
        kinds = {name: known.get(name, 0) | bit for name, bit in bits.items()}
        raw = as_types(stored, types_of(kinds))
    df = refine(
        raw,
        run_ts,
        types,
        ignore_lineage=options.ignore_lineage,
        on_bad_value=options.on_bad_value,
    )
    # Both counts are observed behind the shuffle, in the stage that writes. Tasks of that
    # stage count once each, however often earlier stages are run again after a loss.
    counts = Observation()
    with (
        shuffle_partitions_for(spark, total),
        _marked(df, refined_root, dataset, options) as marked,
    ):
        if partitioning and not changed:
            marked = dealt_out(with_partition(marked, partitioning), partitioning)
        kept = marked.observe(
            counts,
            F.sum(_COPIES).alias("rows_in"),
            F.count_if(~F.col(_KNOWN)).alias("rows_out"),
            F.sum(_BAD_CELLS).alias("bad_cells"),
        )
        kept = kept.where(f"not {_KNOWN}").drop(_COPIES, _BAD_CELLS, _KNOWN)
        if changed:
            path = dataset_path(refined_root, dataset)
            files = spark.read.format("binaryFile").load(paths)
            files = files.select(F.col("_metadata.file_path").alias(SOURCE_FILE))
            replace_files(spark, kept, files, refined_root, dataset, partitioning)
        else:
            column = partitioning.column if partitioning else None
            path = write_refined(kept, refined_root, dataset, options.mode, column)
    drift = registry.add(bits, replace=not appending) if types is None else []
    seen = {name: value or 0 for name, value in counts.get.items()}
    return _result(
        dataset,
        PROCESSED,
        reason=f"types changed: {'; '.join(drift)}" if drift else None,
        refined_path=path,
        rows_in=seen["rows_in"],
        rows_out=seen["rows_out"],
        duplicates=seen["rows_in"] - seen["rows_out"],
        bad_cells=seen["bad_cells"],
    )


def takes_changes(
    spark: SparkSession, refined_root: str, dataset: str, paths: list[str], options: RefineOptions
) -> bool:
    """Whether the stored dataset can take the rows of changed files by themselves.

    It must be stored in the partitions asked for, with the source file as part of its rows and
    with the declared types and columns of these files; anything else needs a rebuild.
    """
    partitioning = options.partition.get(dataset)
    if partitioning is None or dataset not in options.types:
        return False
    if options.mode != "overwrite" or options.ignore_lineage:
        return False
    try:
        stored = read_refined(spark, refined_root, dataset).columns
        raw, _ = read_raw(spark, paths, dataset, options)
    except NoColumns:
        return False
    except AnalysisException as error:
        if is_missing_source(error):
            return False
        raise
    names = normalize_names([*raw.columns[:-1], SOURCE_FILE, INGESTED_AT])
    same = sorted(stored) == sorted([*names, partitioning.column])
    return same and names[-2] == SOURCE_FILE and stored[-1] == partitioning.column


def refine_all(
    spark: SparkSession,
    raw_root: str,
    refined_root: str,
    datasets: str | Iterable[str] | None = None,
    *,
    run_ts: str | None = None,
    fail_on_error: bool = True,
    options: RefineOptions | None = None,
) -> DataFrame:
    """Refines each dataset folder under ``raw_root``; one failure does not stop the rest.

    Returns one row per dataset. Raises ``RefineError`` at the end if any dataset failed,
    unless ``fail_on_error`` is off. ``RefineOptions.at_once`` datasets run side by side.
    """
    sources = {name: dataset_path(raw_root, name) for name in pick_datasets(datasets)}
    return results_table(
        spark, refine_sources(spark, sources, refined_root, run_ts, options), fail_on_error
    )


def refine_sources(
    spark: SparkSession,
    sources: Mapping[str, str | list[str]],
    refined_root: str,
    run_ts: str | None = None,
    options: RefineOptions | None = None,
    changed: Mapping[str, list[str]] | None = None,
) -> list[dict]:
    """One result row per dataset of ``sources`` (dataset to path or list of files), in its order.

    Each dataset has a session of its own, so what is set for one plays no part in another or
    in the caller's session.
    ``changed`` has the new and changed files of partitioned datasets, for those that can take
    them by themselves; ``sources`` is what the others are rebuilt from.
    """
    options = options or RefineOptions()
    run_ts = run_ts or utc_now()

    def one(dataset: str, session: SparkSession) -> dict:
        try:
            some = (changed or {}).get(dataset)
            alone = bool(some) and takes_changes(session, refined_root, dataset, some, options)
            paths = some if alone else sources[dataset]
            result = refine_paths(session, paths, dataset, refined_root, run_ts, options, alone)
        except Exception as error:
            missing = isinstance(error, NoColumns) or is_missing_source(error)
            status = SKIPPED if missing and options.skip_missing else FAILED
            result = _result(dataset, status, reason=str(error))
        logger.info("refine %s", result)
        return result

    work = {dataset: partial(one, dataset) for dataset in sources}
    return side_by_side(spark, work, options.at_once)


def results_table(spark: SparkSession, results: list[dict], fail_on_error: bool) -> DataFrame:
    if fail_on_error and any(row["status"] == FAILED for row in results):
        raise RefineError(results)
    return spark.createDataFrame(results, RESULT_SCHEMA)


def _result(dataset: str, status: str, **values) -> dict:
    row = dict.fromkeys(
        ("reason", "refined_path", "rows_in", "rows_out", "duplicates", "bad_cells")
    )
    return {"dataset": dataset, "status": status, **row, **values}
