"""Refined tables in months, of which only the touched ones are rewritten."""

import datetime as dt
import os

import pytest

from carebase.datasets import STAFFING
from carebase.plans.ingest import ingest
from carebase.plans.months import WORK_MONTH
from carebase.plans.refine import RefineOptions
from carebase.sources.listing import list_files
from carebase.sources.refined import read_refined


class Inbox:
    def __init__(self, spark, root):
        self.spark, self.root, self.day = spark, root, 0
        (root / "inbox").mkdir()

    def put(self, name, *days, header="PROVNUM,STATE,WorkDate,MDScensus", more=""):
        path = self.root / "inbox" / f"PBJ_Daily_Nurse_Staffing_{name}.csv"
        path.write_text("\n".join([header, *(f"1,AL,{day},{n}{more}" for day, n in days)]) + "\n")
        seconds = dt.datetime(2024, 1, self.day + 1, tzinfo=dt.UTC).timestamp()
        os.utime(path, (seconds, seconds))

    def run(self, **options):
        self.day += 1
        return ingest(
            self.spark,
            list_files(self.spark, str(self.root / "inbox")),
            str(self.root / "state"),
            str(self.root / "refined"),
            landing_root=str(self.root / "lake"),
            run_ts=f"2024-05-{self.day:02d}T00:00:00+00:00",
            options=RefineOptions(partition={STAFFING: WORK_MONTH}, **options),
        )

    def rows(self):
        rows = read_refined(self.spark, str(self.root / "refined"), STAFFING).collect()
        return sorted((row.work_month or 0, row.workdate or 0, row.mdscensus) for row in rows)

    def parts(self):
        """Month to the inodes of its files, which change when it is rewritten."""
        folders = (self.root / "refined" / STAFFING).glob("work_month=*")
        return {f.name[11:]: {p.stat().st_ino for p in f.glob("*.parquet")} for f in folders}


@pytest.fixture
def inbox(spark, tmp_path):
    return Inbox(spark, tmp_path)


def test_only_touched_months_are_rewritten(spark, inbox):
    inbox.put("A", (20240101, 1), (20240201, 2))
    inbox.put("B", (20240202, 3), (20240301, 4), ("NA", 9))
    inbox.run()
    assert inbox.rows() == [(0, 0, 9), (202401, 20240101, 1), (202402, 20240201, 2), (202402, 20240202, 3), (202403, 20240301, 4)]
    before = inbox.parts()
    assert set(before) == {"202401", "202402", "202403", "__HIVE_DEFAULT_PARTITION__"}

    # B loses March and its row without a day, keeps one of February, and gains April.
    inbox.put("B", (20240203, 5), (20240401, 6))
    result = inbox.run().results.first()
    assert (result.status, result.rows_in, result.rows_out) == ("processed", 2, 2)
    after = inbox.parts()
    assert inbox.rows() == [(202401, 20240101, 1), (202402, 20240201, 2), (202402, 20240203, 5), (202404, 20240401, 6)]
    assert set(after) == {"202401", "202402", "202404"}
    assert after["202401"] == before["202401"] and after["202402"] != before["202402"]

    plan = read_refined(spark, str(inbox.root / "refined"), STAFFING).where("work_month = 202402")
    plan = plan._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(work_month" in plan and "(work_month" in plan


def test_a_file_without_rows_takes_its_rows_away(inbox):
    inbox.put("A", (20240101, 1))
    inbox.put("B", (20240201, 2))
    inbox.run()
    inbox.put("B")
    inbox.run()
    assert inbox.rows() == [(202401, 20240101, 1)]


def test_other_columns_need_a_rebuild(inbox):
    inbox.put("A", (20240101, 1))
    inbox.run()
    inbox.put("A", (20240101, 1), header="PROVNUM,STATE,WorkDate,MDScensus,Extra", more=",x")
    inbox.run()
    assert inbox.rows() == [(202401, 20240101, 1)]
    inbox.put("B", (20240101, 1), header="PROVNUM,STATE,WorkDate,MDScensus,Extra", more=",y")
    inbox.run(ignore_lineage=True)
    assert len(inbox.rows()) == 2


def test_a_run_that_dies_half_way_is_repeated(inbox, monkeypatch):
    inbox.put("A", (20240101, 1), (20240201, 2))
    inbox.run()
    inbox.put("A", (20240101, 7))

    def crash(*_):
        raise OSError("lost")

    with monkeypatch.context() as patched:
        patched.setattr("carebase.plans.months._drop_partitions", crash)
        with pytest.raises(Exception, match="lost"):
            inbox.run()
    inbox.run()
    assert inbox.rows() == [(202401, 20240101, 7)]
