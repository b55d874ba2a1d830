"""The five curated queries.

Each takes the refined tables and returns a lazy DataFrame. The ``*_from_*`` variants
take a roll-up that is already at hand, so that several views can share one scan.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from carebase.datasets import READMISSION_MEASURES
from carebase.functions.columns import ratio, typed
from carebase.operators.joins import sliced_left_join
from carebase.operators.latest import latest_per_key
from carebase.operators.rollup import FACILITY, facility_months, facility_totals

MEASURE_KEYS = ("measure_code", "resident_type", "measure_period")
CLAIM_KEYS = ("provnum", *MEASURE_KEYS)


# --- monthly views ----------------------------------------------------------
def total_nurse_hours(staffing: DataFrame, on_bad_value: str = "raise") -> DataFrame:
    """Nursing hours per facility, state and month.

    A row with any null hour column adds nothing; a month of such rows only is null.
    """
    return total_nurse_hours_from_months(facility_months(staffing, on_bad_value))


def total_nurse_hours_from_months(months: DataFrame) -> DataFrame:
    return months.selectExpr(*FACILITY, "month_start", "strict_hours as total_nursing_hours")


def employee_vs_contractor_ratio(staffing: DataFrame, on_bad_value: str = "raise") -> DataFrame:
    """Employee and contractor hours per facility, state and month, nulls as zero.

    ``pct_employee_hours`` is the employee share from 0 to 1, null without any hours.
    """
    return employee_vs_contractor_ratio_from_months(facility_months(staffing, on_bad_value))


def employee_vs_contractor_ratio_from_months(months: DataFrame) -> DataFrame:
    share = ratio("employee_hours", "employee_hours + contractor_hours")
    return months.selectExpr(
        *FACILITY,
        "month_start",
        "employee_hours",
        "contractor_hours",
        f"{share} as pct_employee_hours",
    )


# --- facility views ---------------------------------------------------------
def _scored(totals: DataFrame, denominator: str, condition: str = "true") -> DataFrame:
    facilities = totals.selectExpr(
        *FACILITY,
        f"{ratio('patient_days', 'census_days')} as avg_daily_census",
        "nursing_hours as total_nursing_hours",
        "patient_days",
    )
    return facilities.where(condition).selectExpr(
        *FACILITY,
        "avg_daily_census",
        "total_nursing_hours",
        f"{ratio('total_nursing_hours', denominator)} as nhppd",
    )


def staffing_vs_patient_load(staffing: DataFrame) -> DataFrame:
    """Nursing hours per patient-day for each facility and state, null without patient-days."""
    return staffing_vs_patient_load_from_totals(facility_totals(staffing))


def staffing_vs_patient_load_from_totals(totals: DataFrame) -> DataFrame:
    return _scored(totals, "patient_days")


def lowest_staffing_vs_patient_load(
    staffing: DataFrame, tie_break: Sequence[str] = (), limit: int = 10
) -> DataFrame:
    """The facilities with the lowest ``nhppd``, which here divides by the **average**
    census. Which of several equal ones is kept is open unless ``tie_break`` names further
    columns to sort by.
    """
    return lowest_staffing_vs_patient_load_from_totals(facility_totals(staffing), tie_break, limit)


def lowest_staffing_vs_patient_load_from_totals(
    totals: DataFrame, tie_break: Sequence[str] = (), limit: int = 10
) -> DataFrame:
    return (
        _scored(totals, "avg_daily_census", "avg_daily_census > 0")
        .orderBy(F.asc_nulls_last("nhppd"), *tie_break)
        .limit(limit)
    )


# --- readmission ------------------------------------------------------------
def readmission_claims(claims: DataFrame) -> DataFrame:
    """Scored rows of the two readmission measures; both filters reach the Parquet scan."""
    return claims.where(
        f"measure_code in {READMISSION_MEASURES} and adjusted_score is not null"
    ).withColumnRenamed("cms_certification_number_ccn", "provnum")


def latest_claims(
    claims: DataFrame, tie_break: Sequence[str] = (), on_bad_value: str = "raise"
) -> DataFrame:
    """Newest scored row per facility, measure, resident type and period."""
    newest = latest_per_key(readmission_claims(claims), CLAIM_KEYS, "processing_date", tie_break)
    return newest.selectExpr(
        "provnum",
        "state",
        "measure_code",
        "measure_description",
        "resident_type",
        "measure_period",
        f"{typed('adjusted_score', 'double', on_bad_value)} as readmission_value",
    )


def staffing_vs_readmission(
    staffing: DataFrame,
    claims: DataFrame,
    tie_break: Sequence[str] = (),
    on_bad_value: str = "raise",
    slices: int | None = None,
) -> DataFrame:
    """Hours per patient-day next to the newest readmission scores of the facility.

    Facilities without patient-days are left out. The join is on the facility only, so
    the state of the claims row plays no part. One row per facility, state and score;
    facilities without a score appear once with nulls. A facility is spread over up to
    ``slices`` tasks, as many as there are shuffle partitions by default.
    """
    return staffing_vs_readmission_from_totals(
        facility_totals(staffing), claims, tie_break, on_bad_value, slices
    )


def staffing_vs_readmission_from_totals(
    totals: DataFrame,
    claims: DataFrame,
    tie_break: Sequence[str] = (),
    on_bad_value: str = "raise",
    slices: int | None = None,
) -> DataFrame:
    return sliced_left_join(
        _scored(totals, "patient_days", "patient_days > 0"),
        latest_claims(claims, tie_break, on_bad_value).drop("state"),
        readmission_claims(claims),
        "provnum",
        MEASURE_KEYS,
        slices or int(totals.sparkSession.conf.get("spark.sql.shuffle.partitions")),
    )
