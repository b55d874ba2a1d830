"""View definitions that outlive the session: SQL text, kept in versions beside the data.

A store holds the refined tables it is about and an ordered list of views. Any session replays it
and then has all of them; no metastore service takes part. A new set of definitions is tried in a
session of its own first, as a whole, and becomes the newest version only if all of it is valid.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession

from carebase.datasets import CLAIMS, CONTRACTOR_HOURS, EMPLOYEE_HOURS, HOURS, READMISSION_MEASURES, STAFFING
from carebase.functions.columns import filled_total, month_start_between, quoted, ratio, strict_total
from carebase.plans.curated import MEASURE_KEYS
from carebase.plans.views import REPORT_SCHEMA
from carebase.sources.refined import register_refined
from carebase.sources.versions import VersionLog

SLICES = 64


def _order_by(first: str, more: Sequence[str]) -> str:
    return ", ".join([first, *more])


def curated_sql(
    load_tie_break: Sequence[str] = (), claims_tie_break: Sequence[str] = (), slices: int = SLICES
) -> dict[str, str]:
    """The five curated views as Spark SQL over the refined tables, in build order.

    They give the same rows as the functions in ``plans/curated.py``: days are checked per month
    and not per row, and the readmission join is spread over up to ``slices`` tasks per facility.
    """
    months = f"""
        SELECT provnum, state, min(workdate) AS first_day, max(workdate) AS last_day,
               sum({strict_total(HOURS)}) AS strict_hours,
               sum({filled_total(EMPLOYEE_HOURS)}) AS employee_hours,
               sum({filled_total(CONTRACTOR_HOURS)}) AS contractor_hours
        FROM {STAFFING} GROUP BY provnum, state, workdate div 100"""
    month = f"{month_start_between('first_day', 'last_day')} AS month_start"
    facilities = f"""
        SELECT provnum, state, avg(cast(mdscensus AS double)) AS avg_daily_census,
               sum({filled_total(HOURS)}) AS total_nursing_hours,
               sum(cast(mdscensus AS double)) AS patient_days
        FROM {STAFFING} GROUP BY provnum, state"""
    scored = "SELECT provnum, state, avg_daily_census, total_nursing_hours"
    keys = ", ".join(MEASURE_KEYS)
    slice_of = f"cast(pmod(xxhash64({keys}), {slices}) AS int)"
    share = ratio("employee_hours", "employee_hours + contractor_hours")
    return {
        "total_nurse_hours": f"""
        SELECT provnum, state, {month}, strict_hours AS total_nursing_hours FROM ({months})""",
        "employee_vs_contractor_ratio": f"""
        SELECT provnum, state, {month}, employee_hours, contractor_hours,
               {share} AS pct_employee_hours
        FROM ({months})""",
        "staffing_vs_patient_load": f"""
        {scored}, {ratio("total_nursing_hours", "patient_days")} AS nhppd FROM ({facilities})""",
        "lowest_staffing_vs_patient_load": f"""
        {scored}, total_nursing_hours / avg_daily_census AS nhppd
        FROM ({facilities}) WHERE avg_daily_census > 0
        ORDER BY {_order_by("nhppd ASC NULLS LAST", load_tie_break)} LIMIT 10""",
        "staffing_levels_vs_readmission_rates": f"""
        WITH scores AS (
          SELECT *, cms_certification_number_ccn AS facility, {slice_of} AS slice FROM {CLAIMS}
          WHERE measure_code IN {READMISSION_MEASURES} AND adjusted_score IS NOT NULL),
        newest AS (
          SELECT facility, slice, {keys}, measure_description,
                 cast(adjusted_score AS double) AS readmission_value
          FROM (SELECT *, row_number() OVER (
                  PARTITION BY facility, {keys}
                  ORDER BY {_order_by("processing_date DESC NULLS LAST", claims_tie_break)}) AS place
                FROM scores)
          WHERE place = 1),
        present AS (SELECT facility, collect_set(slice) AS slices FROM scores GROUP BY facility),
        load AS (
          {scored}, total_nursing_hours / patient_days AS nhppd
          FROM ({facilities}) WHERE patient_days > 0),
        spread AS (
          SELECT load.*, explode_outer(slices) AS slice
          FROM load LEFT JOIN present ON provnum = facility)
        SELECT provnum, state, avg_daily_census, total_nursing_hours, nhppd, measure_code,
               measure_description, resident_type, measure_period, readmission_value
        FROM spread LEFT JOIN newest ON provnum = facility AND spread.slice = newest.slice""",
    }


class ViewStore:
    """Views over refined data, stored under a path."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark = spark
        self.log = VersionLog(spark, path)

    def definitions(self) -> dict[str, str]:
        """Name to SQL text, in build order."""
        version = self.log.latest()
        return dict(version.content["views"]) if version else {}

    def replace(
        self,
        definitions: Mapping[str, str | None],
        refined_root: str | None = None,
        tables: Sequence[str] = (STAFFING, CLAIMS),
    ) -> dict[str, str]:
        """Adds views, or puts new definitions in place of old ones; returns all of them.

        A replaced view keeps its place in the order, a new one comes last; null or blank text
        leaves a view out. Nothing is stored unless every view of the new set can be built, those
        that read a replaced one included. The tables stay as they are without ``refined_root``.
        """
        version = self.log.latest()
        if version is None and refined_root is None:
            raise ValueError("a new store needs the root of the refined tables")
        content = dict(version.content) if version else {"views": []}
        if refined_root is not None:
            content |= {"root": refined_root, "tables": list(tables)}
        views = dict(content["views"]) | {n: (sql or "").strip() for n, sql in definitions.items()}
        content["views"] = [[name, sql] for name, sql in views.items() if sql]
        _build(self.spark.newSession(), content)
        self.log.commit(version, content)
        return self.definitions()

    def replay(self, spark: SparkSession | None = None) -> DataFrame:
        """Registers tables and views in a session, this store's own by default.

        One row per view. Stops at the first failure, such as a table that has gone.
        """
        spark = spark or self.spark
        version = self.log.latest()
        built = _build(spark, version.content) if version else []
        return spark.createDataFrame([(name, "SUCCEEDED") for name in built], REPORT_SCHEMA)


def _build(spark: SparkSession, content: dict) -> list[str]:
    register_refined(spark, content["root"], content["tables"])
    built = []
    for name, sql in content["views"]:
        try:
            spark.sql(f"CREATE OR REPLACE TEMPORARY VIEW {quoted(name)} AS {sql}")
        except Exception as error:
            raise RuntimeError(f"view {name} failed: {error}") from error
        built.append(name)
    return built


def store_curated_views(
    spark: SparkSession,
    path: str,
    refined_root: str,
    load_tie_break: Sequence[str] = (),
    claims_tie_break: Sequence[str] = (),
) -> ViewStore:
    """The five curated views in the store under ``path``, in place of older definitions."""
    store = ViewStore(spark, path)
    store.replace(curated_sql(load_tie_break, claims_tie_break), refined_root)
    return store
