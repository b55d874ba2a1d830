"""Roll-ups of the staffing fact table.

Both roll-ups carry every measure that any curated query needs. A query that selects a
few of them pays for those only: Catalyst drops unused aggregates and with them the
columns of the scan.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from carebase.datasets import CONTRACTOR_HOURS, EMPLOYEE_HOURS, HOURS
from carebase.functions.columns import (
    filled_total,
    month_start,
    month_start_between,
    strict_total,
)

FACILITY = ("provnum", "state")

_FACILITY_SUMS = {
    "nursing_hours": f"sum({filled_total(HOURS)})",
    "patient_days": "sum(cast(mdscensus as double))",
    "census_days": "count(cast(mdscensus as double))",
}

_MONTH_SUMS = {
    "strict_hours": f"sum({strict_total(HOURS)})",
    "employee_hours": f"sum({filled_total(EMPLOYEE_HOURS)})",
    "contractor_hours": f"sum({filled_total(CONTRACTOR_HOURS)})",
    **_FACILITY_SUMS,
}


def _aliased(expressions: dict[str, str]) -> list:
    return [F.expr(f"{sql} as {name}") for name, sql in expressions.items()]


def facility_months(
    staffing: DataFrame, on_bad_value: str = "raise", by: Sequence[str] = ()
) -> DataFrame:
    """Sums per facility, state and month, and per value of further columns ``by``.

    ``strict_hours`` leaves out rows with any null hour column; the other hour sums count
    nulls as zero.

    Whole-number days are grouped by their first six digits, and the calendar is consulted
    once per group instead of once per row. Text days, and bad days that shall become null,
    need a look at each row.
    """
    whole_number = isinstance(staffing.schema["workdate"].dataType, T.IntegralType)
    if not whole_number or on_bad_value != "raise":
        month = F.expr(f"{month_start('workdate', on_bad_value)} as month_start")
        return staffing.groupBy(*FACILITY, month, *by).agg(*_aliased(_MONTH_SUMS))
    days = {"first_day": "min(workdate)", "last_day": "max(workdate)"}
    grouped = staffing.groupBy(*FACILITY, *by, F.expr("workdate div 100 as month_number"))
    month = f"{month_start_between('first_day', 'last_day')} as month_start"
    return grouped.agg(*_aliased(days | _MONTH_SUMS)).selectExpr(*FACILITY, month, *by, *_MONTH_SUMS)


def merged_months(months: DataFrame) -> DataFrame:
    """One row per facility, state and month of sums that were taken over parts of the facts."""
    sums = {name: f"sum({name})" for name in _MONTH_SUMS}
    return months.groupBy(*FACILITY, "month_start").agg(*_aliased(sums))


def month_recipe() -> str:
    """What the monthly sums are made of; stored sums of another recipe are of no use."""
    return "; ".join([*FACILITY, *(f"{name} = {sql}" for name, sql in _MONTH_SUMS.items())])


def facility_totals(staffing: DataFrame) -> DataFrame:
    """Sums per facility and state over all dates, straight from the fact table."""
    return staffing.groupBy(*FACILITY).agg(*_aliased(_FACILITY_SUMS))


def facility_totals_from_months(months: DataFrame) -> DataFrame:
    """The same totals from stored monthly sums, without another pass over the facts."""
    sums = {name: f"sum({name})" for name in _FACILITY_SUMS}
    return months.groupBy(*FACILITY).agg(*_aliased(sums))
