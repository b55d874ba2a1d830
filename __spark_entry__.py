"""Registered queries and the SQL they are checked against."""

from __future__ import annotations

import functools
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from carebase import fixtures
from carebase.datasets import (
    CLAIMS,
    CONTRACTOR_HOURS,
    EMPLOYEE_HOURS,
    HOURS,
    MISSING_TOKENS,
    READMISSION_MEASURES,
    ROUTES,
    STAFFING,
    UNMAPPED,
)
from carebase.fixtures import with_ctes
from carebase.functions.names import normalize_columns, normalize_names
from carebase.operators import changes, dedupe, routing
from carebase.operators.cleaning import standardize_missing
from carebase.operators.state import STATE_SCHEMA, read_state, record_state
from carebase.plans import curated
from carebase.plans.ingest import ingest
from carebase.plans.months import WORK_MONTH, replace_files, with_partition
from carebase.plans.refine import RefineError, RefineOptions, refine_all, results_table
from carebase.plans.view_store import ViewStore, store_curated_views
from carebase.plans.views import curated_views, refresh_views, register_views, write_views
from carebase.session import scratch_path, written
from carebase.sources.listing import list_files
from carebase.sources.refined import read_refined, write_refined

try:
    import corpus_pipeline
    from carebase.llm import queries as llm
except ModuleNotFoundError as error:
    if error.name not in ("corpus_pipeline", "carebase.llm"):
        raise
    llm = corpus_pipeline = None

FLAGSHIP = "staffing_vs_readmission"
SMALL_TABLES = "/root/testdata/sf0.001"

# Headers as a publisher might write them, for the three columns of the dirty table.
MESSY_HEADERS = (" CMS Certification Number (CCN) ", "Balance / USD - Net", "_Market\tSegment%")
CLEAN_HEADERS = ("cms_certification_number_ccn", "balance_usd_net", "market_segment")
MESSY_DATASET = "nh_provider_info"
MESSY_TYPES = {"balance_usd_net": "double"}


# --- ingest -----------------------------------------------------------------
def _routed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return routing.route_files(fixtures.listing(spark, sf_dir), "raw")


def _changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return changes.detect_changes(_routed(spark, sf_dir), fixtures.state(spark, sf_dir))


def route_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _routed(spark, sf_dir).select(
        "file_id", "file_name", "dataset", "target_path", "is_unmapped"
    )


def unmapped_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _routed(spark, sf_dir).agg(
        F.count("*").alias("files"), F.count_if("is_unmapped").alias("unmapped")
    )


def name_clashes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return routing.name_clashes(_routed(spark, sf_dir))


def file_actions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _changes(spark, sf_dir).select("file_id", "dataset", "action")


def changed_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    files = changes.changed_files(_routed(spark, sf_dir), fixtures.state(spark, sf_dir))
    return files.select("file_id", "file_name", "modified_time", "dataset", "action")


def upserted_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The state of earlier runs and then the files of this one recorded, and read back."""
    path = scratch_path(spark, "state")
    known = fixtures.state(spark, sf_dir)
    done = changes.changed_files(_routed(spark, sf_dir), known)
    for i, rows in enumerate((known, done)):
        columns = ("file_id", "file_name", "modified_time")
        given = {"last_processed_at": f"timestamp_ntz'2024-01-0{i + 1}'"} | {c: c for c in columns}
        fields = (field.split() for field in STATE_SCHEMA.split(", "))
        record_state(
            rows.selectExpr(
                *[f"cast({given.get(name, 'null')} as {kind}) as {name}" for name, kind in fields]
            ),
            path,
        )
    return read_state(spark, path).select("file_id", "file_name", "modified_time")


def ingest_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return changes.ingest_counts(_changes(spark, sf_dir))


def stale_datasets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return changes.stale_datasets(_changes(spark, sf_dir))


# --- refinement -------------------------------------------------------------
def standardized(spark: SparkSession, sf_dir: str) -> DataFrame:
    return standardize_missing(fixtures.dirty(spark, sf_dir))


def normalized(spark: SparkSession, sf_dir: str) -> DataFrame:
    return normalize_columns(fixtures.dirty(spark, sf_dir).toDF(*MESSY_HEADERS))


def without_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedupe.drop_duplicates(standardize_missing(fixtures.dirty_with_copies(spark, sf_dir)))


def dedupe_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedupe.dedupe_report(standardize_missing(fixtures.dirty_with_copies(spark, sf_dir)))


def _refine_roundtrip(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, str]:
    """The dirty rows with copies, written as CSV with messy headers and then refined."""
    raw_root, refined_root = scratch_path(spark, "raw"), scratch_path(spark, "refined")
    (
        fixtures.dirty_with_copies(spark, sf_dir)
        .toDF(*MESSY_HEADERS)
        .write.csv(f"{raw_root}/{MESSY_DATASET}", header=True, escape='"')
    )
    # Which part file a copy lands in is up to the scan, so lineage is left out of the key.
    options = RefineOptions(ignore_lineage=True, types={MESSY_DATASET: MESSY_TYPES})
    results = refine_all(spark, raw_root, refined_root, MESSY_DATASET, options=options)
    return results, refined_root


def refine_csv_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, refined_root = _refine_roundtrip(spark, sf_dir)
    return read_refined(spark, refined_root, MESSY_DATASET).select(*CLEAN_HEADERS)


def refine_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    results, _ = _refine_roundtrip(spark, sf_dir)
    return results.select("dataset", "status", "rows_in", "rows_out", "duplicates", "bad_cells")


# Three layouts of the same customers: columns in another order, and with one more, compressed.
LAYOUTS = (
    (("Cust Key", "Balance", "Seg 1", "Seg/1"), "none"),
    (("seg 1", " BALANCE", "Seg/1", "Cust-Key"), "none"),
    (("Group", "Seg 1", "Cust Key", "Balance", "SEG_1 "), "gzip"),
)
LAYOUT_COLUMNS = {
    "cust_key": "c_custkey",
    "balance": "c_acctbal",
    "seg_1": "seg",
    "seg_1_2": "cast(c_custkey % 5 as string)",
    "group": "c_custkey % 7",
}
LAYOUT_TYPES = ("bigint", "double", "string", "bigint", "bigint")


def united_headers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files of three headers, two with names that are equal once normalised, refined as one table."""
    raw_root, refined_root = scratch_path(spark, "raw"), scratch_path(spark, "refined")
    rows = fixtures.dirty(spark, sf_dir)
    for i, (headers, codec) in enumerate(LAYOUTS):
        some = rows.where(f"c_custkey % {len(LAYOUTS)} = {i}")
        cells = [LAYOUT_COLUMNS[name] for name in normalize_names(headers)]
        named = some.selectExpr(*cells).toDF(*headers)
        options = {"header": True, "escape": '"', "compression": codec}
        options |= {f"ignore{side}WhiteSpace": False for side in ("Leading", "Trailing")}
        named.write.options(**options).mode("append").csv(f"{raw_root}/{MESSY_DATASET}")
    refine_all(spark, raw_root, refined_root, MESSY_DATASET)
    stored = read_refined(spark, refined_root, MESSY_DATASET)
    cells = [f"cast({n} as {t}) as {n}" for n, t in zip(LAYOUT_COLUMNS, LAYOUT_TYPES, strict=True)]
    return stored.selectExpr(*cells)


def refine_statuses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Datasets that are good, fail, have a header only, have no bytes, and are absent, in one run."""
    raw_root, refined_root = scratch_path(spark, "raw"), scratch_path(spark, "refined")
    rows = fixtures.dirty(spark, sf_dir)
    sources = {
        "nh_ownership": rows,
        "nh_penalties": rows.selectExpr("if(c_custkey = 7, 'many', cast(c_acctbal as string)) as c_acctbal"),
        "nh_survey_dates": rows.where("false"),
    }
    for name, df in sources.items():
        df.write.csv(f"{raw_root}/{name}", header=True, escape='"')
    rows.where("false").selectExpr("seg").coalesce(1).write.text(f"{raw_root}/nh_survey_summary")
    names = " nh_ownership/, nh_penalties,nh_survey_dates, nh_survey_summary, swing_bed_snf"
    options = RefineOptions(types={"nh_penalties": {"c_acctbal": "double"}})
    try:
        refine_all(spark, raw_root, refined_root, names, options=options)
        results, raised = [], False
    except RefineError as error:
        results, raised = error.results, True
    table = results_table(spark, results, fail_on_error=False)
    return table.select("dataset", "status", "rows_in", "rows_out", F.lit(raised).alias("raised"))


def refined_lineage(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files that Spark wrote, listed, refined, and the rows and run time of each by file name."""
    raw_root, refined_root = scratch_path(spark, "raw"), scratch_path(spark, "refined")
    rows = fixtures.dirty(spark, sf_dir).withColumn("slice", F.expr(f"c_custkey % {SLICES}"))
    by_slice = rows.repartition("slice").write.partitionBy("slice")
    by_slice.csv(f"{raw_root}/{MESSY_DATASET}", header=True, escape='"')
    refine_all(spark, raw_root, refined_root, MESSY_DATASET, run_ts="2024-02-01T00:00:00+00:00")
    stored = read_refined(spark, refined_root, MESSY_DATASET)
    listed = list_files(spark, f"{raw_root}/{MESSY_DATASET}").select("path", "file_name")
    in_file = F.regexp_extract("source_file", r"/slice=(\d+)/", 1).cast("bigint").alias("slice")
    named = stored.join(listed, F.endswith("source_file", F.regexp_replace("path", "^file:/*", "/")))
    return named.groupBy(in_file, "ingested_at_utc").agg(
        F.count("*").alias("n_rows"), F.sum("c_custkey").cast("bigint").alias("keys")
    )


def text_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Monthly hours of staffing facts whose days are text."""
    facts = fixtures.staffing(spark, sf_dir)
    return curated.total_nurse_hours(facts.withColumn("workdate", F.expr("cast(workdate as string)")))


# --- landing ----------------------------------------------------------------
# The customers fall into slices, one file each. By slice % 5: a file that leaves after the first
# round, one that changes, one of another dataset, one without a rule, one that is added.
SLICES = 40
PROVIDERS, OWNERS = "nh_provider_info", "nh_ownership"
LANDED_NAMES = f"""concat(
    case slice % 5 when 2 then 'NH_Ownership_' when 3 then 'Odd_' else 'NH_ProviderInfo_' end,
    slice, '.csv')"""
LANDED_TYPES = {"c_custkey": "bigint", "c_acctbal": "double"}


def _inbox(spark: SparkSession, sf_dir: str, kinds: tuple[int, ...], raised: int, time: str):
    """The listing of files that hold the slices of some kinds, balances raised by a number."""
    folder = scratch_path(spark, "inbox")
    rows = fixtures.dirty(spark, sf_dir).selectExpr(
        "c_custkey", f"c_acctbal + {raised} as c_acctbal", "seg", f"c_custkey % {SLICES} as slice"
    )
    kept = rows.where(F.expr("slice % 5").isin(*kinds)).repartition("slice")
    kept.write.partitionBy("slice").csv(folder, header=True, escape='"')
    files = list_files(spark, folder).withColumn(
        "slice", F.regexp_extract("path", r"slice=(\d+)", 1).cast("int")
    )
    return files.selectExpr(
        "concat('f', slice) as file_id",
        f"{LANDED_NAMES} as file_name",
        f"timestamp_ntz'{time}' as modified_time",
        "path",
    )


def _two_rounds(spark: SparkSession, sf_dir: str) -> dict[str, str]:
    """Two runs over inboxes that differ by removed, changed and added files; returns the roots."""
    roots = {name: scratch_path(spark, name) for name in ("lake", "state", "refined")}
    options = RefineOptions(types={PROVIDERS: LANDED_TYPES, OWNERS: LANDED_TYPES})
    first = _inbox(spark, sf_dir, (0, 1, 2, 3), 0, "2024-01-01")
    second = first.where("substr(file_id, 2) % 5 in (2, 3)").unionByName(
        _inbox(spark, sf_dir, (1, 4), 1, "2024-01-02")
    )
    for i, listing in enumerate((first, second)):
        ingest(
            spark,
            listing,
            roots["state"],
            roots["refined"],
            landing_root=roots["lake"],
            prefix="raw",
            run_ts=f"2024-02-0{i + 1}T00:00:00+00:00",
            options=options,
        )
    return roots


def landed_rounds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What two runs have refined, and the rows of the landed files that no rule takes."""
    roots = _two_rounds(spark, sf_dir)

    def rows(df: DataFrame, dataset: str) -> DataFrame:
        file_name = "element_at(split(source_file, '/'), -1) as file_name"
        types = {"c_custkey": "bigint", "c_acctbal": "double", "seg": "string"}
        cells = [f"cast({name} as {kind}) as {name}" for name, kind in types.items()]
        return df.selectExpr(f"'{dataset}' as dataset", file_name, *cells)

    odd = spark.read.csv(f"{roots['lake']}/raw/{UNMAPPED}", header=True, escape='"')
    odd = standardize_missing(odd.withColumn("source_file", F.col("_metadata.file_path")))
    tables = [
        rows(read_refined(spark, roots["refined"], name), name) for name in (PROVIDERS, OWNERS)
    ]
    return tables[0].unionByName(tables[1]).unionByName(rows(odd, UNMAPPED))


def landed_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The state after two runs."""
    state = read_state(spark, _two_rounds(spark, sf_dir)["state"])
    return state.select(
        "file_id", "file_name", "modified_time", "key", "dataset_folder", "last_processed_at"
    )


# Rows of the second half from this day on stay in the second round, with another census.
KEPT_FROM, FACTS_OF = 19960301, ("provnum", "state", "workdate", "mdscensus")
# About so many rows make a file: one task reads it, as fields may hold line breaks.
FILE_ROWS = 1_000_000


def _staffing_files(spark: SparkSession, rows: DataFrame, n_files: int, time: str) -> DataFrame:
    """The listing of CSV files that hold ``rows``, one per (half, slice)."""
    folder = scratch_path(spark, "inbox")
    # More partitions than files, so that few tasks get several of them.
    dealt = rows.repartition(8 * n_files, "half", "slice").write.partitionBy("half", "slice")
    dealt.csv(folder, header=True)
    part = "regexp_extract(path, 'half=([0-9])', 1), '_', regexp_extract(path, 'slice=([0-9]+)', 1)"
    return list_files(spark, folder).selectExpr(
        f"concat({part}) as file_id",
        f"concat('PBJ_Daily_Nurse_Staffing_', {part}, '.csv') as file_name",
        f"timestamp_ntz'{time}' as modified_time",
        "path",
    )


def refreshed_months(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Staffing facts in months, of which the second of two runs rewrites those of one half's files."""
    roots = {name: scratch_path(spark, name) for name in ("lake", "state", "refined")}
    facts = fixtures.staffing(spark, sf_dir).select(*FACTS_OF)
    n_files = facts.count() // FILE_ROWS + 1
    # Equal rows share a file, and a row keeps its file when its census changes.
    first = facts.selectExpr(
        "*",
        "cast(provnum as int) % 2 as half",
        f"pmod(xxhash64(provnum, state, workdate), {n_files}) as slice",
    )
    later = first.where(f"half = 1 and workdate >= {KEPT_FROM}").withColumn(
        "mdscensus", F.expr("mdscensus + 1")
    )
    before = written(_staffing_files(spark, first, n_files, "2024-01-01"), "listing")
    after = _staffing_files(spark, later, n_files, "2024-01-02")
    # A file that has lost all its rows is still there, with nothing but its header.
    header = scratch_path(spark, "inbox")
    facts.where("false").coalesce(1).write.csv(header, header=True)
    bare = list_files(spark, header).select("path")
    emptied = before.where("file_id like '1%'").join(after, "file_id", "left_anti")
    emptied = emptied.withColumn("modified_time", F.expr("timestamp_ntz'2024-01-02'")).drop("path")
    after = written(after.unionByName(emptied.crossJoin(bare)), "listing")
    options = RefineOptions(partition={STAFFING: WORK_MONTH})
    for listing in (before, after):
        ingest(spark, listing, roots["state"], roots["refined"], landing_root=roots["lake"], options=options)
    stored = read_refined(spark, roots["refined"], STAFFING)
    return stored.groupBy("work_month", "state").agg(
        F.count("*").alias("n_rows"), F.sum("mdscensus").alias("patient_days")
    )


# --- curated ----------------------------------------------------------------
def total_nurse_hours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return curated.total_nurse_hours(fixtures.staffing(spark, sf_dir))


def employee_vs_contractor_ratio(spark: SparkSession, sf_dir: str) -> DataFrame:
    return curated.employee_vs_contractor_ratio(fixtures.staffing(spark, sf_dir))


def staffing_vs_patient_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    return curated.staffing_vs_patient_load(fixtures.staffing(spark, sf_dir))


def lowest_staffing_vs_patient_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    return curated.lowest_staffing_vs_patient_load(
        fixtures.staffing(spark, sf_dir), tie_break=("provnum", "state")
    )


def latest_claims(spark: SparkSession, sf_dir: str) -> DataFrame:
    return curated.latest_claims(fixtures.claims(spark, sf_dir), tie_break=("row_id",))


def staffing_vs_readmission(spark: SparkSession, sf_dir: str) -> DataFrame:
    return curated.staffing_vs_readmission(
        fixtures.staffing(spark, sf_dir), fixtures.claims(spark, sf_dir), tie_break=("row_id",)
    )


# Each view as (key, value1, value2, value3); lists of the same for Spark and DuckDB.
VIEW_VALUES = {
    "total_nurse_hours": ("cast(month_start as {text})", "total_nursing_hours", "0e0", "0e0"),
    "employee_vs_contractor_ratio": (
        "cast(month_start as {text})",
        "employee_hours",
        "contractor_hours",
        "pct_employee_hours",
    ),
    "staffing_vs_patient_load": ("''", "avg_daily_census", "total_nursing_hours", "nhppd"),
    "lowest_staffing_vs_patient_load": ("''", "avg_daily_census", "total_nursing_hours", "nhppd"),
    "staffing_levels_vs_readmission_rates": (
        "cast(measure_code as {text}) || measure_description || resident_type || measure_period",
        "total_nursing_hours",
        "nhppd",
        "readmission_value",
    ),
}


def _view_values(name: str, text: str) -> list[str]:
    names = ("key", "value1", "value2", "value3")
    values = (value.format(text=text) for value in VIEW_VALUES[name])
    cells = [f"{value} as {column}" for value, column in zip(values, names, strict=True)]
    return [f"'{name}' as view", "provnum", "state", *cells]


def _all_views(views: dict[str, DataFrame]) -> DataFrame:
    rows = [df.selectExpr(*_view_values(name, "string")) for name, df in views.items()]
    return functools.reduce(DataFrame.unionAll, rows)


def written_views(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All five views written in one pass over the facts, and read back."""
    paths = write_views(
        fixtures.staffing(spark, sf_dir),
        fixtures.claims(spark, sf_dir),
        scratch_path(spark, "curated"),
        load_tie_break=("provnum", "state"),
        claims_tie_break=("row_id",),
    )
    return _all_views({name: spark.read.parquet(path) for name, path in paths.items()})


def stored_views(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Definitions stored by one session; all five views read by another one."""
    root, store = scratch_path(spark, "refined"), scratch_path(spark, "views")
    write_refined(fixtures.staffing(spark, sf_dir), root, STAFFING)
    write_refined(fixtures.claims(spark, sf_dir), root, CLAIMS)
    store_curated_views(spark, store, root, ("provnum", "state"), ("row_id",))
    other = spark.newSession()
    ViewStore(other, store).replay()
    return _all_views({name: other.table(name) for name in VIEW_VALUES})


def refreshed_views(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All five views after a second run has read only the months of one changed file."""
    root, target = scratch_path(spark, "refined"), scratch_path(spark, "curated")
    file_name = F.expr("concat('half=', cast(provnum as int) % 2)")
    facts = fixtures.staffing(spark, sf_dir).withColumn("source_file", file_name)
    write_refined(with_partition(facts, WORK_MONTH), root, STAFFING, partition_by=WORK_MONTH.column)
    write_refined(fixtures.claims(spark, sf_dir), root, CLAIMS)
    ties = {"load_tie_break": ("provnum", "state"), "claims_tie_break": ("row_id",)}
    refresh_views(spark, root, target, **ties)
    # A version of one file that is corrected from some day on, and has lost the days before that.
    census = F.expr("mdscensus + 1")
    later = facts.where(f"source_file = 'half=1' and workdate >= {KEPT_FROM}")
    changed = later.withColumn("mdscensus", census)
    replace_files(spark, changed, changed.select("source_file"), root, STAFFING, WORK_MONTH)
    refresh = refresh_views(spark, root, target, **ties)
    return _all_views({name: spark.read.parquet(path) for name, path in refresh.paths.items()})


def registered_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Refined tables written out, the five views registered over them, one read with SQL."""
    root = scratch_path(spark, "refined")
    write_refined(fixtures.staffing(spark, sf_dir), root, STAFFING)
    write_refined(fixtures.claims(spark, sf_dir), root, CLAIMS)
    register_views(spark, curated_views(root))
    return spark.sql("SELECT * FROM staffing_vs_patient_load")


# --- registry ---------------------------------------------------------------
def entry(spark: SparkSession) -> DataFrame:
    return queries()[FLAGSHIP](spark, SMALL_TABLES)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    corpus = llm.QUERIES | {"pipeline": corpus_pipeline.run} if llm else {}
    return corpus | {
        "total_nurse_hours": total_nurse_hours,
        "employee_vs_contractor_ratio": employee_vs_contractor_ratio,
        "staffing_vs_patient_load": staffing_vs_patient_load,
        "lowest_staffing_vs_patient_load": lowest_staffing_vs_patient_load,
        "staffing_vs_readmission": staffing_vs_readmission,
        "latest_claims": latest_claims,
        "written_views": written_views,
        "stored_views": stored_views,
        "refreshed_views": refreshed_views,
        "registered_view": registered_view,
        "route_files": route_files,
        "unmapped_files": unmapped_files,
        "name_clashes": name_clashes,
        "file_actions": file_actions,
        "changed_files": changed_files,
        "upsert_state": upserted_state,
        "ingest_counts": ingest_counts,
        "stale_datasets": stale_datasets,
        "standardize_missing": standardized,
        "normalize_columns": normalized,
        "drop_exact_duplicates": without_duplicates,
        "dedupe_report": dedupe_report,
        "refine_csv_roundtrip": refine_csv_roundtrip,
        "refine_report": refine_report,
        "united_headers": united_headers,
        "refine_statuses": refine_statuses,
        "refined_lineage": refined_lineage,
        "text_days": text_days,
        "landed_rounds": landed_rounds,
        "landed_state": landed_state,
        "refreshed_months": refreshed_months,
    }


# --- oracle SQL -------------------------------------------------------------
def _strict(columns: tuple[str, ...]) -> str:
    return " + ".join(columns)


def _filled(columns: tuple[str, ...]) -> str:
    return " + ".join(f"coalesce({column}, 0)" for column in columns)


_MONTH = "date_trunc('month', strptime(cast(workdate AS varchar), '%Y%m%d'))::timestamp"

_MONTHLY_HOURS = f"""
    SELECT provnum, state, {_MONTH} AS month_start, sum({_strict(HOURS)}) AS total_nursing_hours
    FROM staffing GROUP BY ALL"""

_MONTHLY_SHARE = f"""
    SELECT *, employee_hours / nullif(employee_hours + contractor_hours, 0) AS pct_employee_hours
    FROM (
      SELECT provnum, state, {_MONTH} AS month_start,
             sum({_filled(EMPLOYEE_HOURS)}) AS employee_hours,
             sum({_filled(CONTRACTOR_HOURS)}) AS contractor_hours
      FROM staffing GROUP BY ALL)"""

_FACILITY = f"""
      SELECT provnum, state, avg(cast(mdscensus AS double)) AS avg_daily_census,
             sum(cast(mdscensus AS double)) AS patient_days,
             sum({_filled(HOURS)}) AS total_nursing_hours
      FROM staffing GROUP BY provnum, state"""

_LOAD = f"""
    SELECT provnum, state, avg_daily_census, total_nursing_hours,
           total_nursing_hours / nullif(patient_days, 0) AS nhppd
    FROM ({_FACILITY})"""

_LOWEST = f"""
    SELECT provnum, state, avg_daily_census, total_nursing_hours,
           total_nursing_hours / avg_daily_census AS nhppd
    FROM ({_FACILITY}) WHERE avg_daily_census > 0
    ORDER BY nhppd ASC NULLS LAST, provnum, state LIMIT 10"""

_LATEST = f"""
    SELECT cms_certification_number_ccn AS provnum, state, measure_code, measure_description,
           resident_type, measure_period, cast(adjusted_score AS double) AS readmission_value
    FROM claims
    WHERE measure_code IN {READMISSION_MEASURES} AND adjusted_score IS NOT NULL
    QUALIFY row_number() OVER (
      PARTITION BY cms_certification_number_ccn, measure_code, resident_type, measure_period
      ORDER BY processing_date DESC NULLS LAST, row_id) = 1"""

_READMISSION = f"""
    SELECT s.*, r.* EXCLUDE (provnum, state)
    FROM (SELECT provnum, state, avg_daily_census, total_nursing_hours,
                 total_nursing_hours / patient_days AS nhppd
          FROM ({_FACILITY}) WHERE patient_days > 0) AS s
    LEFT JOIN ({_LATEST}) AS r ON s.provnum = r.provnum"""

_RULES = " ".join(
    f"WHEN regexp_matches(file_name, '(?i){pattern}') THEN '{dataset}'"
    for dataset, pattern in ROUTES.items()
)

_ROUTED = f"""
    SELECT *, concat('raw/', dataset, '/', file_name) AS target_path,
           dataset = '{UNMAPPED}' AS is_unmapped
    FROM (SELECT *, CASE {_RULES} ELSE '{UNMAPPED}' END AS dataset
          FROM listing WHERE lower(file_name) LIKE '%.csv')"""

_ACTIONS = f"""
    SELECT l.*, CASE WHEN s.file_id IS NULL THEN 'new'
                     WHEN l.modified_time IS NULL OR s.modified_time IS NULL
                          OR l.modified_time > s.modified_time THEN 'changed'
                     ELSE 'unchanged' END AS action
    FROM ({_ROUTED}) AS l LEFT JOIN state AS s ON l.file_id = s.file_id"""

_SEGMENT = f"CASE WHEN lower(trim(seg)) NOT IN {MISSING_TOKENS} THEN seg END"

_REPORT = f"""
    SELECT (SELECT count(*) FROM dirty_copies) AS rows_in, count(*) AS rows_out
    FROM (SELECT DISTINCT c_custkey, c_acctbal, {_SEGMENT} AS seg FROM dirty_copies)"""


_ALL_VIEWS = " UNION ALL ".join(
    f"SELECT {', '.join(_view_values(name, 'varchar'))} FROM ({query})"
    for name, query in {
        "total_nurse_hours": _MONTHLY_HOURS,
        "employee_vs_contractor_ratio": _MONTHLY_SHARE,
        "staffing_vs_patient_load": _LOAD,
        "lowest_staffing_vs_patient_load": _LOWEST,
        "staffing_levels_vs_readmission_rates": _READMISSION,
    }.items()
)

_SLICED = f"""
    SELECT *, concat('f', slice::varchar) AS file_id,
           concat(CASE slice % 5 WHEN 2 THEN 'NH_Ownership_' WHEN 3 THEN 'Odd_'
                  ELSE 'NH_ProviderInfo_' END, slice::varchar, '.csv') AS file_name,
           CASE slice % 5 WHEN 2 THEN 'nh_ownership' WHEN 3 THEN '_unmapped'
                ELSE 'nh_provider_info' END AS dataset,
           slice % 5 IN (1, 4) AS is_second
    FROM (SELECT *, (c_custkey % {SLICES})::int AS slice FROM dirty)"""


def oracle_sql() -> dict[str, str]:
    def listed(query: str) -> str:
        return with_ctes(query, "listing", "state")

    corpus = dict(llm.ORACLE_SQL) if llm else {}
    if llm and corpus_pipeline.ORACLE_SQL:
        corpus["pipeline"] = corpus_pipeline.ORACLE_SQL
    return corpus | {
        "total_nurse_hours": with_ctes(_MONTHLY_HOURS, "staffing"),
        "employee_vs_contractor_ratio": with_ctes(_MONTHLY_SHARE, "staffing"),
        "staffing_vs_patient_load": with_ctes(_LOAD, "staffing"),
        "lowest_staffing_vs_patient_load": with_ctes(_LOWEST, "staffing"),
        "staffing_vs_readmission": with_ctes(_READMISSION, "staffing", "claims"),
        "latest_claims": with_ctes(_LATEST, "claims"),
        "written_views": with_ctes(_ALL_VIEWS, "staffing", "claims"),
        "stored_views": with_ctes(_ALL_VIEWS, "staffing", "claims"),
        "refreshed_views": with_ctes(
            f"""WITH renewed AS (
                SELECT * REPLACE ((mdscensus + provnum::int % 2)::int AS mdscensus)
                FROM staffing WHERE provnum::int % 2 = 0 OR workdate >= {KEPT_FROM})
            {_ALL_VIEWS.replace("FROM staffing", "FROM renewed")}""",
            "staffing",
            "claims",
        ),
        "registered_view": with_ctes(_LOAD, "staffing"),
        "route_files": with_ctes(
            f"SELECT file_id, file_name, dataset, target_path, is_unmapped FROM ({_ROUTED})",
            "listing",
        ),
        "unmapped_files": with_ctes(
            f"SELECT count(*) AS files, count(*) FILTER (is_unmapped) AS unmapped FROM ({_ROUTED})",
            "listing",
        ),
        "name_clashes": with_ctes(
            f"SELECT target_path, count(*) AS files FROM ({_ROUTED}) GROUP BY 1 HAVING count(*) > 1",
            "listing",
        ),
        "file_actions": listed(f"SELECT file_id, dataset, action FROM ({_ACTIONS})"),
        "changed_files": listed(
            f"""SELECT file_id, file_name, modified_time, dataset, action
            FROM ({_ACTIONS}) WHERE action <> 'unchanged'"""
        ),
        "upsert_state": listed(
            f"""
            WITH done AS (SELECT * FROM ({_ACTIONS}) WHERE action <> 'unchanged')
            SELECT file_id, file_name, modified_time FROM state
            WHERE file_id NOT IN (SELECT file_id FROM done)
            UNION ALL SELECT file_id, file_name, modified_time FROM done"""
        ),
        "ingest_counts": listed(
            f"""SELECT count(*) FILTER (action <> 'unchanged') AS processed,
                       count(*) FILTER (action = 'unchanged') AS skipped,
                       count(*) FILTER (action <> 'unchanged' AND is_unmapped) AS unmapped
            FROM ({_ACTIONS})"""
        ),
        "stale_datasets": listed(
            f"""SELECT DISTINCT dataset FROM ({_ACTIONS})
            WHERE action <> 'unchanged' AND NOT is_unmapped"""
        ),
        "standardize_missing": with_ctes(
            f"SELECT c_custkey, c_acctbal, {_SEGMENT} AS seg FROM dirty", "dirty"
        ),
        "normalize_columns": with_ctes(
            "SELECT c_custkey AS cms_certification_number_ccn, c_acctbal AS balance_usd_net, "
            "seg AS market_segment FROM dirty",
            "dirty",
        ),
        "drop_exact_duplicates": with_ctes(
            f"SELECT DISTINCT c_custkey, c_acctbal, {_SEGMENT} AS seg FROM dirty_copies",
            "dirty_copies",
        ),
        "dedupe_report": with_ctes(
            f"SELECT *, rows_in - rows_out AS dropped FROM ({_REPORT})", "dirty_copies"
        ),
        "refine_csv_roundtrip": with_ctes(
            f"""SELECT DISTINCT cast(c_custkey AS varchar) AS cms_certification_number_ccn,
                       c_acctbal AS balance_usd_net, {_SEGMENT} AS market_segment
            FROM dirty_copies""",
            "dirty_copies",
        ),
        "united_headers": with_ctes(
            f"""SELECT c_custkey AS cust_key, c_acctbal AS balance, {_SEGMENT} AS seg_1,
                       c_custkey % 5 AS seg_1_2,
                       CASE WHEN c_custkey % 3 = 2 THEN c_custkey % 7 END AS "group"
            FROM dirty""",
            "dirty",
        ),
        "refine_statuses": with_ctes(
            """SELECT dataset, status, n * counted AS rows_in, n * counted AS rows_out,
                      true AS raised
            FROM (SELECT count(*) AS n FROM dirty), (VALUES
              ('nh_ownership', 'processed', 1::bigint), ('nh_penalties', 'failed', NULL),
              ('nh_survey_dates', 'processed', 0), ('nh_survey_summary', 'skipped_missing', NULL),
              ('swing_bed_snf', 'skipped_missing', NULL)) AS t(dataset, status, counted)""",
            "dirty",
        ),
        "refined_lineage": with_ctes(
            f"""SELECT c_custkey % {SLICES} AS slice,
                       '2024-02-01T00:00:00+00:00' AS ingested_at_utc, count(*) AS n_rows,
                       sum(c_custkey)::bigint AS keys
            FROM dirty GROUP BY ALL""",
            "dirty",
        ),
        "text_days": with_ctes(_MONTHLY_HOURS, "staffing"),
        "landed_rounds": with_ctes(
            f"""SELECT DISTINCT dataset, file_name, c_custkey,
                       c_acctbal + CASE WHEN is_second THEN 1 ELSE 0 END AS c_acctbal,
                       {_SEGMENT} AS seg
            FROM ({_SLICED})""",
            "dirty",
        ),
        "refreshed_months": with_ctes(
            f"""SELECT (workdate // 100)::int AS work_month, state, count(*) AS n_rows,
                       sum(mdscensus::double) AS patient_days
            FROM (SELECT DISTINCT provnum, state, workdate,
                         mdscensus + provnum::int % 2 AS mdscensus
                  FROM staffing WHERE provnum::int % 2 = 0 OR workdate >= {KEPT_FROM})
            GROUP BY ALL""",
            "staffing",
        ),
        "landed_state": with_ctes(
            f"""SELECT DISTINCT file_id, file_name, concat('raw/', dataset, '/', file_name) AS key,
                       dataset AS dataset_folder,
                       CASE WHEN is_second THEN TIMESTAMP '2024-01-02'
                            ELSE TIMESTAMP '2024-01-01' END AS modified_time,
                       CASE WHEN is_second THEN TIMESTAMP '2024-02-02'
                            ELSE TIMESTAMP '2024-02-01' END AS last_processed_at
            FROM ({_SLICED})""",
            "dirty",
        ),
        "refine_report": with_ctes(
            f"""SELECT '{MESSY_DATASET}' AS dataset, 'processed' AS status, rows_in, rows_out,
                       rows_in - rows_out AS duplicates, cast(0 AS bigint) AS bad_cells
            FROM ({_REPORT})""",
            "dirty_copies",
        ),
    }
