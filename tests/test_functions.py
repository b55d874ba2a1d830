"""Name rules and column expressions on rows made here."""

import datetime as dt
import string

import pytest
from hypothesis import given
from hypothesis import strategies as st
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from carebase.datasets import DATASETS, MISSING_TOKENS, pick_datasets
from carebase.functions.columns import (
    filled_total,
    month_start,
    month_start_between,
    null_if_missing,
    number_or_date,
    ratio,
    strict_total,
    typed,
)
from carebase.functions.names import normalize_columns, normalize_name, normalize_names, unique_names


@pytest.mark.parametrize(
    ("header", "name"),
    [
        (" CMS Certification Number (CCN) ", "cms_certification_number_ccn"),
        ("A/B - C", "a_b_c"),
        ("%%", "col"),
        ("", "col"),
        ("_source_file", "source_file"),
        ("Número", "nmero"),
        ("a\t-/ b", "a_b"),
        ("A\nB", "ab"),
        ("__x__y__", "x_y"),
    ],
)
def test_normalize_name(header, name):
    assert normalize_name(header) == name


@pytest.mark.parametrize(
    ("headers", "names"),
    [
        (["a b", "a-b", "a/b"], ["a_b", "a_b_2", "a_b_3"]),
        (["x", "x-", "x_2"], ["x", "x_2", "x_2_2"]),
        (["x_2", "x", "x"], ["x_2", "x", "x_3"]),
        (["?", "!", "col"], ["col", "col_2", "col_3"]),
    ],
)
def test_names_become_unique(headers, names):
    assert normalize_names(headers) == names


@given(st.lists(st.text(alphabet="ab_2 -", max_size=4), max_size=12))
def test_names_never_repeat(headers):
    names = normalize_names(headers)
    assert len(set(names)) == len(names) == len(headers)


@given(st.text())
def test_names_are_plain_and_stable(header):
    name = normalize_name(header)
    assert set(name) <= set(string.ascii_lowercase + string.digits + "_")
    assert normalize_name(name) == name


def test_unique_names_leave_distinct_names_alone():
    assert unique_names(["b", "a", "a_2"]) == ["b", "a", "a_2"]


def test_normalize_columns_of_a_frame(spark):
    df = spark.createDataFrame([(1, 2, 3)], ["a b", "A-B", "%"])
    assert normalize_columns(df).columns == ["a_b", "a_b_2", "col"]


def test_missing_tokens(spark):
    values = ["N/A", " na ", "", "NULL", ".", "   ", "NaN", "None", None]
    kept = [" TX ", "nan.", "nano", "\t", "0", "n / a"]
    df = spark.createDataFrame([(v,) for v in values + kept], "v string")
    got = [row.v for row in df.selectExpr(f"{null_if_missing('v')} as v").collect()]
    assert got == [None] * len(values) + kept
    assert len(MISSING_TOKENS) == 7


@pytest.mark.parametrize("data_type", ["int", "double", "float", "date"])
def test_numbers_and_dates_of_text(spark, data_type):
    tokens = ["N/A", " na ", "", "NULL", ".", "   ", "NaN", " nan", "None", None]
    good = {"date": "2024-10-01"}.get(data_type, " 12 ")
    df = spark.createDataFrame([(v,) for v in [*tokens, good]], "v string")
    expected = df.selectExpr(f"cast({null_if_missing('v')} as {data_type}) as v").collect()
    assert [row.v is None for row in expected] == [True] * len(tokens) + [False]
    for mode in ("raise", "null"):
        got = df.selectExpr(f"{number_or_date('v', data_type, mode)} as v").collect()
        assert got == expected
    bad = spark.createDataFrame([("x1",)], "v string")
    with pytest.raises(PySparkException, match="CAST_INVALID_INPUT"):
        bad.selectExpr(number_or_date("v", data_type)).collect()
    assert bad.selectExpr(f"{number_or_date('v', data_type, 'null')} as v").first().v is None


def test_totals_and_ratio(spark):
    df = spark.createDataFrame([(1.0, 2.0), (None, 2.0), (None, None)], "a double, b double")
    rows = df.selectExpr(
        f"{strict_total(['a', 'b'])} as s",
        f"{filled_total(['a', 'b'])} as f",
        f"{ratio('1D', filled_total(['a', 'b']))} as r",
    ).collect()
    assert [tuple(row) for row in rows] == [(3.0, 3.0, 1 / 3), (None, 2.0, 0.5), (None, 0.0, None)]


def test_bad_numbers_raise_or_become_null(spark):
    df = spark.createDataFrame([("1.5",), ("x",)], "v string")
    with pytest.raises(PySparkException, match="CAST_INVALID_INPUT"):
        df.selectExpr(typed("v", "double")).collect()
    lenient = df.selectExpr(f"{typed('v', 'double', 'null')} as v").collect()
    assert [row.v for row in lenient] == [1.5, None]
    with pytest.raises(ValueError, match="on_bad_value"):
        typed("v", "double", "ignore")


def test_month_start_of_text(spark):
    df = spark.createDataFrame([("20240229",), (None,)], "d string")
    got = [row.m for row in df.selectExpr(f"{month_start('d')} as m").collect()]
    assert got == [dt.datetime(2024, 2, 1), None]
    bad = spark.createDataFrame([("20230229",)], "d string")
    with pytest.raises(PySparkException):
        bad.selectExpr(month_start("d")).collect()
    assert bad.selectExpr(f"{month_start('d', 'null')} as m").first().m is None


@pytest.mark.parametrize("first, last", [(20240201, 20240229), (20240210, 20240210)])
def test_month_start_of_numbers(spark, first, last):
    df = spark.createDataFrame([(first, last)], "a int, b int")
    row = df.select(F.expr(month_start_between("a", "b")).alias("m")).first()
    assert row.m == dt.datetime(2024, 2, 1)


@pytest.mark.parametrize(
    "first, last",
    [
        (20230201, 20230229),
        (20230200, 20230201),
        (20231301, 20231302),
        (2024101, 2024101),
        (120240101, 120240101),
        (-20240101, -20240101),
        (0, 0),
    ],
)
def test_numbers_that_are_no_days_raise(spark, first, last):
    df = spark.createDataFrame([(first, last)], "a int, b int")
    with pytest.raises(PySparkException):
        df.select(F.expr(month_start_between("a", "b"))).collect()


def test_pick_datasets():
    assert pick_datasets() == list(DATASETS) and len(DATASETS) == 21
    assert pick_datasets(" a , /b/ ,, ") == ["a", "b"]
    assert pick_datasets(["x/"]) == ["x"]
