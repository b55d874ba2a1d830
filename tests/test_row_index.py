"""Append runs that add no row twice."""

import pytest

from carebase.datasets import STAFFING
from carebase.plans.months import WORK_MONTH
from carebase.plans.refine import RefineOptions, refine_all
from carebase.sources.refined import read_refined
from carebase.sources.row_index import RowIndex

OTHER = "nh_provider_info"


@pytest.fixture
def append(spark, tmp_path):
    def run(name, text, dataset=OTHER, mode="append", **options):
        folder = tmp_path / name / dataset
        folder.mkdir(parents=True, exist_ok=True)
        (folder / "a.csv").write_text(text)
        options = RefineOptions(mode=mode, **{"skip_stored": True, "ignore_lineage": True} | options)
        row = refine_all(spark, str(tmp_path / name), str(tmp_path / "refined"), dataset, options=options).first()
        return row.rows_in, row.rows_out, row.duplicates

    return run


@pytest.fixture
def stored(spark, tmp_path):
    return lambda dataset=OTHER: read_refined(spark, str(tmp_path / "refined"), dataset)


def test_the_same_rows_twice_add_nothing(append, stored):
    text = "k,v,w\n1,,x\n2,NA,\n2,NA,\n3,0.0,y\n"
    assert append("one", text) == (4, 3, 1)
    assert append("one", text) == (4, 0, 4)
    # Another file with one row that is new; null and a value in other columns are not equal.
    assert append("two", "w,v,k\n,x,1\nx,,1\ny,-0.0,3\n") == (3, 2, 1)
    rows = stored().collect()
    assert len(rows) == 5 and sum(r.k == 1 for r in rows) == 2


def test_the_source_file_counts_unless_it_is_ignored(append, stored):
    assert append("one", "k\n1\n", ignore_lineage=False) == (1, 1, 0)
    assert append("one", "k\n1\n", ignore_lineage=False) == (1, 0, 1)
    assert append("two", "k\n1\n", ignore_lineage=False) == (1, 1, 0)
    # Compared by other columns, the index is built anew.
    assert append("three", "k\n1\n2\n") == (2, 1, 1)


def test_rows_stored_without_the_index_are_found(append, stored):
    assert append("one", "k\n1\n", skip_stored=False) == (1, 1, 0)
    assert append("two", "k\n1\n2\n") == (2, 1, 1)
    assert append("three", "k\n5\n", skip_stored=False) == (1, 1, 0)
    assert append("four", "k\n5\n6\n") == (2, 1, 1)
    # Rows that an overwrite has removed are not known any more.
    assert append("five", "k\n9\n", mode="overwrite") == (1, 1, 0)
    assert append("six", "k\n1\n9\n") == (2, 1, 1)
    assert sorted(r.k for r in stored().collect()) == [1, 9]


def test_a_table_in_months(append, stored):
    options = {"dataset": STAFFING, "partition": {STAFFING: WORK_MONTH}}
    assert append("one", "PROVNUM,WorkDate\n1,20240401\n1,20240501\n", **options) == (2, 2, 0)
    assert append("two", "PROVNUM,WorkDate\n1,20240501\n2,20240501\n", **options) == (2, 1, 1)
    assert sorted((r.provnum, r.work_month) for r in stored(STAFFING).collect()) == [
        ("1", 202404),
        ("1", 202405),
        ("2", 202405),
    ]


def test_a_lost_index_step_is_caught_up(spark, append, tmp_path, monkeypatch):
    """Hashes written, but a crash before their files were listed: they come twice, to no effect."""
    append("one", "k\n1\n2\n")
    index = RowIndex(spark, str(tmp_path / "refined"), OTHER, ["k"])
    version = index.catch_up()
    none = spark.createDataFrame([], "file string")
    none.write.mode("overwrite").parquet(f"{index.log.path}/{version.content['folder']}/files")
    assert append("two", "k\n2\n3\n") == (2, 1, 1)


def test_the_index_grows_with_the_data(spark, append, tmp_path, monkeypatch):
    append("one", "k\n1\n")
    first = RowIndex(spark, str(tmp_path / "refined"), OTHER, ["k"]).catch_up()
    monkeypatch.setattr("carebase.sources.row_index.PARTITION_BYTES", 20)
    second = RowIndex(spark, str(tmp_path / "refined"), OTHER, ["k"]).catch_up()
    assert second.content["buckets"] > 4 * first.content["buckets"]
    assert append("two", "k\n1\n2\n") == (2, 1, 1)


def test_the_stored_side_is_not_shuffled(spark, append, tmp_path):
    append("one", "k\n" + "".join(f"{i}\n" for i in range(100)))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        df = spark.range(50, 150).selectExpr("cast(id as int) as k")
        index = RowIndex(spark, str(tmp_path / "refined"), OTHER, ["k"])
        with index.marked(df, "known") as marked:
            plan = marked._jdf.queryExecution().executedPlan().toString()
            assert plan.count("Exchange") == 1 and "Bucketed: true" in plan, plan
            assert marked.where("known").count() == 50 and marked.count() == 100
        assert not [t for t in spark.catalog.listTables() if t.name.startswith("carebase_rows")]
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
