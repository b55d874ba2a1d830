"""Curated views: registered for SQL, or written out."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from carebase.datasets import CLAIMS, STAFFING, dataset_path
from carebase.operators.rollup import facility_months, facility_totals_from_months
from carebase.plans import curated
from carebase.plans.monthly_sums import MonthlySums
from carebase.session import written
from carebase.sources.refined import read_refined

Definition = Callable[[SparkSession], DataFrame] | str | None

REPORT_SCHEMA = "view string, state string"


def curated_views(
    root: str,
    load_tie_break: Sequence[str] = (),
    claims_tie_break: Sequence[str] = (),
    on_bad_value: str = "raise",
) -> dict[str, Definition]:
    """The five curated views over the refined data under ``root``, in build order.

    The tie breaks order facilities of equal load, and claims rows of equal date.
    """

    def staffing(spark: SparkSession) -> DataFrame:
        return read_refined(spark, root, STAFFING)

    return {
        "total_nurse_hours": lambda spark: curated.total_nurse_hours(staffing(spark)),
        "employee_vs_contractor_ratio": lambda spark: curated.employee_vs_contractor_ratio(
            staffing(spark)
        ),
        "staffing_vs_patient_load": lambda spark: curated.staffing_vs_patient_load(
            staffing(spark)
        ),
        "lowest_staffing_vs_patient_load": lambda spark: curated.lowest_staffing_vs_patient_load(
            staffing(spark), tie_break=load_tie_break
        ),
        "staffing_levels_vs_readmission_rates": lambda spark: curated.staffing_vs_readmission(
            staffing(spark), read_refined(spark, root, CLAIMS), claims_tie_break, on_bad_value
        ),
    }


def register_views(spark: SparkSession, definitions: Mapping[str, Definition]) -> DataFrame:
    """Registers each definition as a view, in the order given; stops at the first failure.

    A definition is a function of the session or Spark SQL text; empty text is skipped.
    Views are lazy. The result has one row per registered view.
    """
    report = []
    for name, definition in definitions.items():
        if isinstance(definition, str):
            definition = definition.strip()
        if not definition:
            continue
        try:
            df = spark.sql(definition) if isinstance(definition, str) else definition(spark)
            df.createOrReplaceTempView(name)
        except Exception as error:
            raise RuntimeError(f"view {name} failed: {error}") from error
        report.append((name, "SUCCEEDED"))
    return spark.createDataFrame(report, REPORT_SCHEMA)


def write_views(
    staffing: DataFrame,
    claims: DataFrame,
    root: str,
    load_tie_break: Sequence[str] = (),
    claims_tie_break: Sequence[str] = (),
    on_bad_value: str = "raise",
) -> dict[str, str]:
    """Writes all five views as Parquet in place of older ones; returns their paths.

    The fact table is scanned once: its monthly sums are stored, and with them the sums per
    facility; every view is derived from these. Only the order in which hours are added
    differs from the lazy views.
    """
    months = written(facility_months(staffing), "facility_months")
    return _write_from_months(months, claims, root, load_tie_break, claims_tie_break, on_bad_value)


@dataclass(frozen=True)
class Refresh:
    """``paths`` of the views; ``months`` whose facts were read, null for days without one."""

    paths: dict[str, str]
    months: list[int | None]


def refresh_views(
    spark: SparkSession,
    refined_root: str,
    root: str,
    load_tie_break: Sequence[str] = (),
    claims_tie_break: Sequence[str] = (),
    on_bad_value: str = "raise",
) -> Refresh:
    """Writes all five views like ``write_views``, but reads the facts of changed months only.

    The refined staffing table must be stored by month. Its monthly sums are kept under
    ``<root>/_facility_months``; the first refresh takes them over all months.
    """
    path = dataset_path(root, "_facility_months")
    sums = MonthlySums(spark, path, dataset_path(refined_root, STAFFING))
    touched = sums.refresh()
    claims = read_refined(spark, refined_root, CLAIMS)
    ties = (load_tie_break, claims_tie_break)
    return Refresh(_write_from_months(sums.read(), claims, root, *ties, on_bad_value), touched)


def _write_from_months(
    months: DataFrame,
    claims: DataFrame,
    root: str,
    load_tie_break: Sequence[str],
    claims_tie_break: Sequence[str],
    on_bad_value: str,
) -> dict[str, str]:
    totals = written(facility_totals_from_months(months), "facility_totals")
    views = {
        "total_nurse_hours": curated.total_nurse_hours_from_months(months),
        "employee_vs_contractor_ratio": curated.employee_vs_contractor_ratio_from_months(months),
        "staffing_vs_patient_load": curated.staffing_vs_patient_load_from_totals(totals),
        "lowest_staffing_vs_patient_load": curated.lowest_staffing_vs_patient_load_from_totals(
            totals, tie_break=load_tie_break
        ),
        "staffing_levels_vs_readmission_rates": curated.staffing_vs_readmission_from_totals(
            totals, claims, claims_tie_break, on_bad_value
        ),
    }
    paths = {}
    for name, df in views.items():
        paths[name] = dataset_path(root, name)
        df.write.mode("overwrite").parquet(paths[name])
    return paths
