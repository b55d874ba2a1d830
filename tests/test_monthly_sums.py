"""Written views that a refresh brings up to date from the months that have changed."""

import os

import pytest
from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from carebase import fixtures
from carebase.datasets import CLAIMS, STAFFING
from carebase.jobs import main
from carebase.operators.rollup import facility_months
from carebase.plans import monthly_sums
from carebase.plans.monthly_sums import MonthlySums
from carebase.plans.months import WORK_MONTH, replace_files, with_partition
from carebase.plans.views import refresh_views, write_views
from carebase.sources.refined import read_refined, write_refined
from carebase.sources.versions import VersionConflict

DATA = "/root/testdata/sf0.001"
TIES = {"load_tie_break": ("provnum", "state"), "claims_tie_break": ("row_id",)}


def store(spark, root, facts):
    write_refined(with_partition(facts, WORK_MONTH), root, STAFFING, partition_by="work_month")


@pytest.fixture
def facts(spark):
    facts = fixtures.staffing(spark, DATA).where("workdate < 19950701")
    return facts.withColumn("source_file", F.expr("concat('f', workdate div 100)"))


@pytest.fixture
def lake(spark, tmp_path, facts):
    root = str(tmp_path / "refined")
    store(spark, root, facts)
    write_refined(fixtures.claims(spark, DATA), root, CLAIMS)
    return root


def rows(df):
    return sorted(map(repr, df.collect()))


def same_as_rebuilt(spark, lake, tmp_path, refresh):
    staffing = read_refined(spark, lake, STAFFING).drop("work_month")
    rebuilt = write_views(
        staffing, read_refined(spark, lake, CLAIMS), str(tmp_path / "rebuilt"), **TIES
    )
    assert refresh.paths.keys() == rebuilt.keys()
    for name, path in refresh.paths.items():
        ours, theirs = spark.read.parquet(path), spark.read.parquet(rebuilt[name])
        assert ours.dtypes == theirs.dtypes
        assert rows(ours) == rows(theirs), name


def spoil(lake, month):
    """Makes the facts of a month unreadable without a sign of it in the listing.

    The footers stay, since Spark takes the columns of a table from one of them.
    """
    for path in os.scandir(f"{lake}/{STAFFING}/work_month={month}"):
        if not path.name.endswith(".parquet"):
            continue
        status = path.stat()
        with open(path, "r+b") as file:
            file.seek(-8, os.SEEK_END)
            footer = int.from_bytes(file.read(4), "little")
            file.seek(0)
            file.write(b"\0" * (status.st_size - footer - 8))
        os.remove(f"{lake}/{STAFFING}/work_month={month}/.{path.name}.crc")
        os.utime(path, ns=(status.st_atime_ns, status.st_mtime_ns))


def test_only_changed_months_are_read(spark, lake, facts, tmp_path):
    target = str(tmp_path / "curated")
    first = refresh_views(spark, lake, target, **TIES)
    months = [row[0] for row in facts.selectExpr("workdate div 100 as m").distinct().collect()]
    assert first.months == sorted(months) and len(months) > 3
    same_as_rebuilt(spark, lake, tmp_path, first)

    changed = facts.where(f"source_file = 'f{max(months)}'").withColumn("mdscensus", F.lit(3))
    replace_files(spark, changed, changed.select("source_file"), lake, STAFFING, WORK_MONTH)
    whole = {name: str(tmp_path / "whole" / name) for name in (STAFFING, CLAIMS)}
    for name, path in whole.items():
        read_refined(spark, lake, name).write.parquet(path)
    for month in sorted(months)[:-1]:
        spoil(lake, month)
    with pytest.raises((PySparkException, Py4JJavaError)):
        facility_months(read_refined(spark, lake, STAFFING)).collect()
    second = refresh_views(spark, lake, target, **TIES)
    assert second.months == [max(months)]
    same_as_rebuilt(spark, str(tmp_path / "whole"), tmp_path, second)
    assert refresh_views(spark, lake, target, **TIES).months == []


def test_months_that_leave_come_and_lack_a_day(spark, lake, facts, tmp_path):
    target = str(tmp_path / "curated")
    refresh_views(spark, lake, target, **TIES)
    last = facts.agg(F.max("source_file")).first()[0]
    gone = facts.where(f"source_file = '{last}'").select("source_file")
    replace_files(spark, facts.where("false"), gone, lake, STAFFING, WORK_MONTH)
    dateless = facts.where(f"source_file = '{last}'").limit(5)
    dateless = dateless.withColumn("workdate", F.lit(None).cast("int"))
    with_partition(dateless, WORK_MONTH).write.mode("append").partitionBy("work_month").parquet(
        f"{lake}/{STAFFING}"
    )
    refresh = refresh_views(spark, lake, target, **TIES)
    assert refresh.months == [int(last[1:]), None]
    same_as_rebuilt(spark, lake, tmp_path, refresh)


def test_another_recipe_starts_anew(spark, lake, tmp_path, monkeypatch):
    sums = MonthlySums(spark, str(tmp_path / "sums"), f"{lake}/{STAFFING}")
    first = sums.refresh()
    monkeypatch.setattr(monthly_sums, "month_recipe", lambda: "another")
    assert sums.read().isEmpty()
    assert sums.refresh() == first


def test_empty_table_gives_empty_views(spark, lake, facts, tmp_path):
    empty = str(tmp_path / "empty")
    day = facts.limit(1)
    store(spark, empty, day)
    sums = MonthlySums(spark, str(tmp_path / "sums"), f"{empty}/{STAFFING}")
    assert len(sums.refresh()) == 1
    replace_files(
        spark, facts.where("false"), day.select("source_file"), empty, STAFFING, WORK_MONTH
    )
    schema = facility_months(facts).schema
    spark.createDataFrame([], with_partition(facts, WORK_MONTH).schema).write.mode("append").parquet(
        f"{empty}/{STAFFING}/work_month=199501"
    )
    sums.refresh()
    assert sums.read().isEmpty()
    assert [f.name for f in sums.read().schema] == [f.name for f in schema]


def test_a_refresh_that_dies_leaves_the_older_sums(spark, lake, facts, tmp_path, monkeypatch):
    path = tmp_path / "sums"
    sums = MonthlySums(spark, str(path), f"{lake}/{STAFFING}")
    sums.refresh()
    before = rows(sums.read())
    changed = facts.where("source_file = 'f199503'").withColumn("hrs_rn", F.lit(1.0))
    replace_files(spark, changed, changed.select("source_file"), lake, STAFFING, WORK_MONTH)

    def conflict(base, content):
        raise VersionConflict("another was faster")

    with monkeypatch.context() as patch, pytest.raises(VersionConflict):
        patch.setattr(sums.log, "commit", conflict)
        sums.refresh()
    assert rows(sums.read()) == before and len(sums.log.data_folders()) == 1
    assert sums.refresh() == [199503]
    assert rows(sums.read()) != before


def test_folders_of_forgotten_versions_go(spark, lake, facts, tmp_path):
    sums = MonthlySums(spark, str(tmp_path / "sums"), f"{lake}/{STAFFING}")
    sums.refresh()
    for day in range(4):
        changed = facts.where("source_file = 'f199503'").withColumn("mdscensus", F.lit(day))
        replace_files(spark, changed, changed.select("source_file"), lake, STAFFING, WORK_MONTH)
        assert sums.refresh() == [199503]
    assert len(sums.log.data_folders()) == 3
    assert rows(sums.read()) == rows(facility_months(read_refined(spark, lake, STAFFING)))


def test_table_without_months_is_refused(spark, facts, tmp_path):
    write_refined(facts, str(tmp_path), STAFFING)
    with pytest.raises(ValueError, match="work_month"):
        MonthlySums(spark, str(tmp_path / "sums"), f"{tmp_path}/{STAFFING}").refresh()


def test_command_line(spark, lake, tmp_path, capsys):
    target = str(tmp_path / "curated")
    main(["views", "--refined", lake, "--curated", target, "--refresh"], spark)
    assert len(capsys.readouterr().out.split()) == 5
    assert spark.read.parquet(f"{target}/total_nurse_hours").count() > 0
