"""The test tables recast in the shapes the operators read.

Each shape is written once, as SQL expressions that Spark and DuckDB both run; only the
name of the text type differs. Spark gets DataFrames, DuckDB gets the same as a CTE.
"""

from __future__ import annotations

from collections.abc import Callable
from textwrap import dedent

from pyspark.sql import DataFrame, SparkSession

from carebase.datasets import HOUR_ROLES
from carebase.operators.latest import latest_per_key

# One name per routing rule (one of them in other case), then four that no rule takes.
FILE_NAMES = (
    "FY_2024_SNF_VBP_Aggregate_Performance.csv",
    "FY_2024_SNF_VBP_Facility_Performance.csv",
    "NH_CitationDescriptions_Oct2024.csv",
    "NH_CovidVaxAverages_20241027.csv",
    "NH_CovidVaxProvider_20241027.csv",
    "NH_DataCollectionIntervals_Oct2024.csv",
    "NH_FireSafetyCitations_Oct2024.csv",
    "NH_HealthCitations_Oct2024.csv",
    "NH_HlthInspecCutpointsState_Oct2024.csv",
    "NH_Ownership_Oct2024.csv",
    "NH_Penalties_Oct2024.csv",
    "nh_providerinfo_oct2024.CSV",
    "NH_QualityMsr_Claims_Oct2024.csv",
    "NH_QualityMsr_MDS_Oct2024.csv",
    "NH_StateUSAverages_Oct2024.csv",
    "NH_SurveyDates_Oct2024.csv",
    "NH_SurveySummary_Oct2024.csv",
    "PBJ_Daily_Nurse_Staffing_Q2_2024.csv",
    "Skilled_Nursing_Facility_Quality_Reporting_Program_National_Data_Oct2024.csv",
    "Skilled_Nursing_Facility_Quality_Reporting_Program_Provider_Data_Oct2024.csv",
    "Swing_Bed_SNF_data_Oct2024.csv",
    "Provider_Random_2024.csv",
    "readme.txt",
    "NH_Ownership_Oct2024.xlsx",
    "FY_24_SNF_VBP_Facility_Performance.csv",
)

DIRTY_SEGMENTS = ("N/A", " na ", "", "NULL", ".", "   ", "NaN", "None")


def _case(subject: str, values: tuple[str, ...], otherwise: str) -> str:
    branches = " ".join(f"when {i} then '{value}'" for i, value in enumerate(values))
    return f"case {subject} {branches} else {otherwise} end"


# --- expressions, by output column ------------------------------------------
def staffing_columns(text: str) -> dict[str, str]:
    columns = {
        "provnum": f"lpad(cast(l_suppkey as {text}), 6, '0')",
        "state": "n_name",
        "workdate": "cast(year(l_shipdate)*10000 + month(l_shipdate)*100 + day(l_shipdate) as int)",
        "mdscensus": "case when l_suppkey % 10 = 0 then 0 "
        "else cast(l_linenumber*10 + l_partkey % 7 as int) end",
    }
    for i, role in enumerate(HOUR_ROLES):
        columns[f"hrs_{role}"] = (
            f"case when l_orderkey % {97 + i} = 0 then cast(null as double) "
            f"else l_quantity*2 + {i} end"
        )
        columns[f"hrs_{role}_emp"] = (
            f"case when l_suppkey % 10 = 5 then 0e0 when l_orderkey % {11 + i} = 0 "
            f"then cast(null as double) else l_quantity + {i} end"
        )
        columns[f"hrs_{role}_ctr"] = (
            f"case when l_suppkey % 10 = 5 then 0e0 when l_partkey % {5 + i} = 0 "
            f"then cast(null as double) when l_linenumber > 3 then l_quantity else 0e0 end"
        )
    return columns


def claims_columns(text: str) -> dict[str, str]:
    return {
        "cms_certification_number_ccn": f"lpad(cast((o_custkey % 50)*3 as {text}), 6, '0')",
        "state": "n_name",
        "measure_code": "case o_orderkey % 4 when 0 then 521 when 1 then 551 "
        "when 2 then 479 else 480 end",
        "measure_description": f"concat('measure ', cast(o_orderkey % 4 as {text}))",
        "resident_type": "case when o_orderkey % 4 < 2 then 'Short Stay' else 'Long Stay' end",
        "measure_period": f"concat(cast(year(o_orderdate) as {text}), 'H', "
        "case when month(o_orderdate) <= 6 then '1' else '2' end)",
        "adjusted_score": f"case when o_orderkey % 7 = 0 then cast(null as {text}) "
        f"else cast(cast(floor(o_totalprice) as bigint) as {text}) end",
        "processing_date": "cast(o_orderdate as date)",
        "row_id": "o_orderkey",
    }


def file_columns(text: str) -> dict[str, str]:
    return {
        "file_id": f"concat('f', cast(user_id as {text}))",
        "file_name": _case("user_id % 25", FILE_NAMES, "null"),
        "mime_type": "'text/csv'",
        "modified_time": "ts",
        "size": "cast(1 as bigint)",
        "event_id": "event_id",
        "user_id": "user_id",
    }


def dirty_columns(text: str) -> dict[str, str]:
    return {
        "c_custkey": "c_custkey",
        "c_acctbal": "c_acctbal",
        "seg": _case("c_custkey % 9", DIRTY_SEGMENTS, "c_mktsegment"),
    }


# Types of the test tables, so that no job has to look them up in the files.
TABLES = {
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, "
    "c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
    "o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, "
    "l_quantity double, l_extendedprice double, l_discount double, l_tax double, "
    "l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, "
    "value double, props string",
}

STATE_ROWS = "event_id % 3 = 0 and user_id % 4 <> 0"
COPIED_ROWS = "c_custkey % 10 = 0"


# --- Spark ------------------------------------------------------------------
def _project(df: DataFrame, columns: Callable[[str], dict[str, str]]) -> DataFrame:
    return df.selectExpr(*[f"{sql} as {name}" for name, sql in columns("string").items()])


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(TABLES[name]).parquet(f"{sf_dir}/{name}.parquet")


def staffing(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem")
    suppliers = table(spark, sf_dir, "supplier")
    nations = table(spark, sf_dir, "nation")
    joined = lines.join(suppliers, lines.l_suppkey == suppliers.s_suppkey).join(
        nations, suppliers.s_nationkey == nations.n_nationkey
    )
    return _project(joined, staffing_columns)


def claims(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders")
    customers = table(spark, sf_dir, "customer")
    nations = table(spark, sf_dir, "nation")
    joined = orders.join(customers, orders.o_custkey == customers.c_custkey).join(
        nations, customers.c_nationkey == nations.n_nationkey
    )
    return _project(joined, claims_columns)


def listing(spark: SparkSession, sf_dir: str) -> DataFrame:
    files = _project(table(spark, sf_dir, "events"), file_columns)
    return latest_per_key(files, ["file_id"], "modified_time", ["event_id desc"])


def state(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Key, name and time of the files seen before."""
    files = _project(table(spark, sf_dir, "events").filter(STATE_ROWS), file_columns)
    newest = latest_per_key(files, ["file_id"], "modified_time", ["event_id desc"])
    return newest.select("file_id", "file_name", "modified_time")


def dirty(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _project(table(spark, sf_dir, "customer"), dirty_columns)


def dirty_with_copies(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = dirty(spark, sf_dir)
    return df.unionAll(df.filter(COPIED_ROWS))


# --- DuckDB -----------------------------------------------------------------
def _select(columns: Callable[[str], dict[str, str]], source: str) -> str:
    outputs = ",\n    ".join(f"{sql} AS {name}" for name, sql in columns("varchar").items())
    return f"SELECT\n    {outputs}\n  FROM {source}"


def _newest(rows: str) -> str:
    return (
        f"SELECT * FROM ({rows}) AS f QUALIFY row_number() OVER "
        "(PARTITION BY file_id ORDER BY modified_time DESC NULLS LAST, event_id DESC) = 1"
    )


def ctes() -> dict[str, str]:
    """Body of each derived table, in DuckDB's dialect."""
    dirty_rows = _select(dirty_columns, "customer")
    return {
        "staffing": _select(
            staffing_columns,
            "lineitem JOIN supplier ON l_suppkey = s_suppkey "
            "JOIN nation ON s_nationkey = n_nationkey",
        ),
        "claims": _select(
            claims_columns,
            "orders JOIN customer ON o_custkey = c_custkey "
            "JOIN nation ON c_nationkey = n_nationkey",
        ),
        "listing": _newest(_select(file_columns, "events")),
        "state": _newest(_select(file_columns, f"events WHERE {STATE_ROWS}")),
        "dirty": dirty_rows,
        "dirty_copies": f"{dirty_rows}\n  UNION ALL {dirty_rows} WHERE {COPIED_ROWS}",
    }


def with_ctes(query: str, *names: str) -> str:
    """``query`` behind the named derived tables. A query may bring CTEs of its own."""
    bodies = ctes()
    derived = ",\n".join(f"{name} AS (\n  {bodies[name]}\n)" for name in names)
    query = dedent(query).strip()
    if query.upper().startswith("WITH "):
        return f"WITH {derived},\n{query[5:]}"
    return f"WITH {derived}\n{query}"
