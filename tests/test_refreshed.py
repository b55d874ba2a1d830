"""Refreshes of large files: spread over tasks, with the rows of whole files."""

import __spark_entry__ as registry
import duckdb
from pyspark.sql import functions as F

from carebase.datasets import STAFFING
from carebase.plans import months
from carebase.plans.months import WORK_MONTH, replace_files, with_partition
from carebase.sources.refined import read_refined, write_refined


def test_stored_rows_are_not_shuffled_by_file(spark, tmp_path, monkeypatch):
    rows = spark.range(200).selectExpr(
        "cast(id as int) as n", "cast(20240101 + id % 3 * 100 as int) as workdate",
        "concat('file', id % 2) as source_file",
    )
    root, plans, store = str(tmp_path), [], months.written
    write_refined(with_partition(rows, WORK_MONTH), root, STAFFING, partition_by="work_month")

    def written(df, name):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        return store(df, name)

    monkeypatch.setattr(months, "written", written)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        changed = rows.where("source_file = 'file1' and n < 100").withColumn("n", F.expr("n + 1000"))
        replace_files(spark, changed, changed.select("source_file"), root, STAFFING, WORK_MONTH)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert any("LeftAnti" in plan for plan in plans)
    assert not any("SortMergeJoin" in plan or "ShuffledHashJoin" in plan for plan in plans)
    left = sorted(row.n for row in read_refined(spark, root, STAFFING).collect())
    assert left == sorted([*range(0, 200, 2), *range(1001, 1100, 2)])


def test_months_of_many_files_equal_the_sql(spark, tmp_path, monkeypatch):
    """Files of few rows each; that of one facility has no rows left in the second round."""
    lines = spark.range(300).selectExpr(
        "id as l_orderkey", "id % 5 as l_partkey", "id % 6 as l_suppkey",
        "cast(id % 4 as int) as l_linenumber", "1d as l_quantity", "1d as l_extendedprice",
        "0d as l_discount", "0d as l_tax", "'N' as l_returnflag", "'O' as l_linestatus",
        "timestamp_ntz'1996-01-05' + make_interval(0, 0, 0, cast(if(id % 6 = 1, 0, id) as int)) as l_shipdate",
    )
    suppliers = spark.range(6).selectExpr(
        "id as s_suppkey", "'s' as s_name", "cast(id % 2 as int) as s_nationkey", "0d as s_acctbal"
    )
    nations = spark.range(2).selectExpr(
        "cast(id as int) as n_nationkey", "concat('N', id) as n_name", "1 as n_regionkey"
    )
    tables = {"lineitem": lines.union(lines.where("l_orderkey < 40")), "supplier": suppliers, "nation": nations}
    duck = duckdb.connect()
    for name, df in tables.items():
        df.write.parquet(f"{tmp_path}/{name}.parquet")
        duck.execute(f"CREATE VIEW {name} AS SELECT * FROM '{tmp_path}/{name}.parquet/*.parquet'")
    monkeypatch.setattr(registry, "FILE_ROWS", 10)
    listed, files = [], registry._staffing_files

    def counted(*args):
        listing = files(*args)
        listed.append(listing.count())
        return listing

    monkeypatch.setattr(registry, "_staffing_files", counted)
    got = registry.refreshed_months(spark, str(tmp_path)).collect()
    expected = duck.execute(registry.oracle_sql()["refreshed_months"]).fetchall()
    assert sorted(map(tuple, got)) == sorted(expected)
    assert listed[0] > 10
