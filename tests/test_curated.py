"""Null, zero, tie and skew cases of the curated queries."""

import datetime as dt
import re

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from carebase import fixtures
from carebase.datasets import CONTRACTOR_HOURS, EMPLOYEE_HOURS, HOURS
from carebase.operators.joins import sliced_left_join
from carebase.operators.latest import latest_per_key
from carebase.operators.rollup import facility_months, facility_totals_from_months
from carebase.plans import curated

SMALL = "/root/testdata/sf0.001"
ALL_HOURS = HOURS + EMPLOYEE_HOURS + CONTRACTOR_HOURS


def staffing(spark, *rows, day_type="int"):
    """Rows of (provnum, state, workdate, census, total, employee, contractor) hours; each hour
    value is put into all eight roles."""
    hours = ", ".join(f"{name} double" for name in ALL_HOURS)
    data = [
        (*row[:4], *(value for value in row[4:] for _ in HOURS))
        for row in rows
    ]
    schema = f"provnum string, state string, workdate {day_type}, mdscensus int, {hours}"
    return spark.createDataFrame(data, schema)


def tuples(df, *order):
    return [tuple(row) for row in df.orderBy(*order).collect()]


def test_one_null_hour_takes_the_row_out_of_monthly_totals(spark):
    df = staffing(
        spark,
        ("1", "TX", 20240105, 10, 1.0, 0.0, 0.0),
        ("1", "TX", 20240131, 10, None, 0.0, 0.0),
        ("1", "TX", 20240201, 10, None, 0.0, 0.0),
        ("1", "TX", None, 10, 2.0, 0.0, 0.0),
    )
    assert tuples(curated.total_nurse_hours(df), "month_start") == [
        ("1", "TX", None, 16.0),
        ("1", "TX", dt.datetime(2024, 1, 1), 8.0),
        ("1", "TX", dt.datetime(2024, 2, 1), None),
    ]


def test_text_days_give_the_same_months(spark):
    rows = [("1", "TX", 20240105, 10, 1.0, 0.0, 0.0), ("1", "TX", 20240229, 10, 2.0, 0.0, 0.0)]
    numbers = curated.total_nurse_hours(staffing(spark, *rows))
    texts = [(*row[:2], str(row[2]), *row[3:]) for row in rows]
    text_days = curated.total_nurse_hours(staffing(spark, *texts, day_type="string"))
    assert numbers.schema == text_days.schema
    assert tuples(numbers, "month_start") == tuples(text_days, "month_start")


def test_impossible_days_raise_unless_told_otherwise(spark):
    df = staffing(
        spark,
        ("1", "TX", 20240230, 10, 1.0, 0.0, 0.0),
        ("1", "TX", 20240201, 10, 1.0, 0.0, 0.0),
    )
    with pytest.raises(PySparkException):
        curated.total_nurse_hours(df).collect()
    assert tuples(curated.total_nurse_hours(df, "null"), "month_start") == [
        ("1", "TX", None, 8.0),
        ("1", "TX", dt.datetime(2024, 2, 1), 8.0),
    ]


def test_employee_share(spark):
    df = staffing(
        spark,
        ("1", "TX", 20240105, 10, 0.0, 3.0, 1.0),
        ("1", "TX", 20240106, 10, 0.0, None, None),
        ("2", "TX", 20240105, 10, 0.0, 0.0, None),
    )
    month = dt.datetime(2024, 1, 1)
    assert tuples(curated.employee_vs_contractor_ratio(df), "provnum") == [
        ("1", "TX", month, 24.0, 8.0, 0.75),
        ("2", "TX", month, 0.0, 0.0, None),
    ]


LOADS = (
    ("1", "TX", 20240105, 10, 1.0, 0.0, 0.0),
    ("1", "TX", 20240106, 30, None, 0.0, 0.0),
    ("1", "TX", 20240107, None, 1.0, 0.0, 0.0),
    ("2", "TX", 20240105, 0, 1.0, 0.0, 0.0),
    ("3", "TX", 20240105, None, 1.0, 0.0, 0.0),
    ("4", "TX", 20240105, 8, None, 0.0, 0.0),
)


def test_hours_per_patient_day(spark):
    got = tuples(curated.staffing_vs_patient_load(staffing(spark, *LOADS)), "provnum")
    assert got == [
        ("1", "TX", 20.0, 16.0, 0.4),
        ("2", "TX", 0.0, 8.0, None),
        ("3", "TX", None, 8.0, None),
        ("4", "TX", 8.0, 0.0, 0.0),
    ]


def test_lowest_divides_by_the_average_census(spark):
    got = [tuple(r) for r in curated.lowest_staffing_vs_patient_load(staffing(spark, *LOADS)).collect()]
    assert got == [("4", "TX", 8.0, 0.0, 0.0), ("1", "TX", 20.0, 16.0, 0.8)]


def test_lowest_keeps_ten_and_breaks_ties(spark):
    rows = [(f"{i:02}", "TX", 20240105, 10, 1.0, 0.0, 0.0) for i in range(15)]
    df = curated.lowest_staffing_vs_patient_load(staffing(spark, *rows), tie_break=("provnum",))
    assert [row.provnum for row in df.collect()] == [f"{i:02}" for i in range(10)]


CLAIM_SCHEMA = (
    "cms_certification_number_ccn string, state string, measure_code int, "
    "measure_description string, resident_type string, measure_period string, "
    "adjusted_score string, processing_date date, row_id int"
)


def claim(ccn, code, score, day, row_id=0, resident="Short Stay", period="2024H1"):
    date = day and dt.date(2024, 1, day)
    return (ccn, "TX", code, f"m{code}", resident, period, score, date, row_id)


def claims(spark, *rows):
    return spark.createDataFrame(list(rows), CLAIM_SCHEMA)


def test_latest_claims(spark):
    df = claims(
        spark,
        claim("1", 521, "1.5", 1),
        claim("1", 521, "2.5", 2, row_id=2),
        claim("1", 521, "3.5", 2, row_id=1),
        claim("1", 521, None, 3),
        claim("1", 551, "9", None),
        claim("1", 551, "8", 1),
        claim("1", 479, "7", 1),
    )
    got = tuples(
        curated.latest_claims(df, ("row_id",)).select("measure_code", "readmission_value"),
        "measure_code",
    )
    assert got == [(521, 3.5), (551, 8.0)]


def test_bad_scores_raise_unless_told_otherwise(spark):
    df = claims(spark, claim("1", 521, "high", 1))
    with pytest.raises(PySparkException):
        curated.latest_claims(df).collect()
    assert curated.latest_claims(df, on_bad_value="null").first().readmission_value is None


def test_readmission_keeps_facilities_without_scores(spark):
    facts = staffing(
        spark,
        ("1", "TX", 20240105, 10, 1.0, 0.0, 0.0),
        ("1", "OK", 20240105, 10, 2.0, 0.0, 0.0),
        ("2", "TX", 20240105, 10, 1.0, 0.0, 0.0),
        ("3", "TX", 20240105, 0, 1.0, 0.0, 0.0),
        (None, "TX", 20240105, 10, 1.0, 0.0, 0.0),
    )
    scores = claims(
        spark,
        claim("1", 521, "1", 1),
        claim("1", 551, "2", 1),
        claim("1", 521, "3", 1, period=None),
        claim("3", 521, "4", 1),
        claim("9", 521, "5", 1),
        claim(None, 521, "6", 1),
    )
    df = curated.staffing_vs_readmission(facts, scores)
    got = tuples(
        df.select("provnum", "state", "measure_code", "measure_period", "readmission_value"),
        "provnum",
        "state",
        "readmission_value",
    )
    assert got == [
        (None, "TX", None, None, None),
        ("1", "OK", 521, "2024H1", 1.0),
        ("1", "OK", 551, "2024H1", 2.0),
        ("1", "OK", 521, None, 3.0),
        ("1", "TX", 521, "2024H1", 1.0),
        ("1", "TX", 551, "2024H1", 2.0),
        ("1", "TX", 521, None, 3.0),
        ("2", "TX", None, None, None),
    ]


@pytest.mark.parametrize("slices", [1, 2, 16, 200])
def test_sliced_join_equals_plain_join_when_one_key_holds_a_third(spark, slices):
    right = spark.range(3000).selectExpr("if(id % 3 = 0, 7, id % 90) as k", "id as v")
    left = spark.range(120).selectExpr("id as k", "id * 10 as w")
    plain = left.join(right, "k", "left")
    sliced = sliced_left_join(left, right, right, "k", ["v"], slices)
    assert sliced.columns == plain.columns
    assert tuples(sliced, "k", "v") == tuples(plain, "k", "v")


def test_sliced_join_spreads_a_hot_key(spark):
    right = spark.range(3000).selectExpr("7 as k", "id as v")
    left = spark.range(5, 9).selectExpr("id as k")
    df = sliced_left_join(left, right, right, "k", ["v"], 16)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        tasks = df.where("k = 7").groupBy(F.spark_partition_id()).count()
        sizes = [row["count"] for row in tasks.collect()]
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert sum(sizes) == 3000 and len(sizes) > 3 and max(sizes) < 1500


def test_slice_count_is_checked(spark):
    df = spark.range(1).selectExpr("id as k", "id as v")
    with pytest.raises(ValueError, match="slices"):
        sliced_left_join(df.select("k"), df, df, "k", ["v"], 0)


def test_newest_row_is_limited_before_the_shuffle(spark):
    df = latest_per_key(fixtures.claims(spark, SMALL), ["state"], "processing_date")
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert plan.index("Final") < plan.index("Exchange hashpartitioning(state") < plan.index("Partial")


def test_monthly_sums_give_the_same_facility_totals(spark):
    facts = fixtures.staffing(spark, SMALL)
    months = facility_totals_from_months(facility_months(facts))
    direct = curated.staffing_vs_patient_load(facts)
    derived = curated.staffing_vs_patient_load_from_totals(months)
    assert tuples(derived, "provnum", "state") == tuples(direct, "provnum", "state")


def test_only_the_columns_of_a_view_are_read(spark, tmp_path):
    path = str(tmp_path / "facts")
    fixtures.staffing(spark, SMALL).write.parquet(path)
    plan = curated.staffing_vs_patient_load(spark.read.parquet(path))._jdf.queryExecution()
    scanned = re.search(r"FileScan parquet \[(.*?)\]", plan.executedPlan().toString())[1]
    assert {name.split("#")[0] for name in scanned.split(",")} == {
        "provnum",
        "state",
        "mdscensus",
        *HOURS,
    }


def test_claims_filters_reach_the_scan(spark, tmp_path):
    path = str(tmp_path / "claims")
    fixtures.claims(spark, SMALL).write.parquet(path)
    plan = curated.latest_claims(spark.read.parquet(path))._jdf.queryExecution()
    text = plan.executedPlan().toString()
    assert "In(measure_code, [521,551])" in text and "IsNotNull(adjusted_score)" in text
