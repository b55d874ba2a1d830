"""Listing, routing, change detection, state and the whole incremental run."""

import datetime as dt
import os

import pytest

from carebase.datasets import CLAIMS, CONTRACTOR_HOURS, EMPLOYEE_HOURS, HOURS, ROUTES, STAFFING
from carebase.fixtures import FILE_NAMES
from carebase.operators.changes import (
    changed_files,
    detect_changes,
    ingest_counts,
    stale_datasets,
)
from carebase.operators.routing import name_clashes, route_files
from carebase.operators.state import (
    FOLD_AFTER,
    STATE_SCHEMA,
    StateTable,
    read_state,
    record_state,
    state_rows,
    upsert_state,
)
from carebase.plans.ingest import changed_dataset_files, dataset_files, ingest
from carebase.plans.refine import RefineError, RefineOptions
from carebase.plans.views import curated_views, register_views, write_views
from carebase.session import scratch_path
from carebase.sources.listing import list_files
from carebase.sources.refined import read_refined
from carebase.sources.versions import VersionConflict, VersionLog

T1, T2 = dt.datetime(2024, 1, 1), dt.datetime(2024, 1, 2)
LISTING = "file_id string, file_name string, modified_time timestamp_ntz, path string"
OWNERSHIP, PENALTIES = "NH_Ownership_Oct2024.csv", "NH_Penalties_Oct2024.csv"


def listing(spark, *rows):
    return spark.createDataFrame([(*row, f"/in/{row[0]}") for row in rows], LISTING)


def state(spark, *rows):
    return spark.createDataFrame(
        [(*row, "b", "k", "d", T1) for row in rows], STATE_SCHEMA
    )


def test_every_rule_takes_its_file(spark):
    df = spark.createDataFrame([(name,) for name in FILE_NAMES], "file_name string")
    got = {row.file_name: row.dataset for row in route_files(df).collect()}
    expected = dict(zip(FILE_NAMES, ROUTES, strict=False))
    for name in ("Provider_Random_2024.csv", "FY_24_SNF_VBP_Facility_Performance.csv"):
        expected[name] = "_unmapped"
    assert got == expected


@pytest.mark.parametrize("prefix, path", [("", ""), ("raw", "raw/"), ("/a/b/", "a/b/")])
def test_target_path(spark, prefix, path):
    df = spark.createDataFrame([(OWNERSHIP,), ("x.CSV",)], "file_name string")
    got = [row.target_path for row in route_files(df, prefix).orderBy("target_path").collect()]
    assert got == [f"{path}_unmapped/x.CSV", f"{path}nh_ownership/{OWNERSHIP}"]


def test_changes(spark):
    routed = route_files(
        listing(
            spark,
            ("same", OWNERSHIP, T1),
            ("older", OWNERSHIP, T1),
            ("newer", OWNERSHIP, T2),
            ("fresh", PENALTIES, T1),
            ("no_time", PENALTIES, None),
            ("no_state_time", PENALTIES, T1),
            ("odd", "odd.csv", T1),
            ("text", "readme.txt", T1),
        )
    )
    known = state(
        spark,
        ("same", OWNERSHIP, T1),
        ("older", OWNERSHIP, T2),
        ("newer", OWNERSHIP, T1),
        ("no_time", PENALTIES, T1),
        ("no_state_time", PENALTIES, None),
        ("gone", PENALTIES, T1),
    )
    changes = detect_changes(routed, known)
    assert {row.file_id: row.action for row in changes.collect()} == {
        "same": "unchanged",
        "older": "unchanged",
        "newer": "changed",
        "fresh": "new",
        "no_time": "changed",
        "no_state_time": "changed",
        "odd": "new",
    }
    assert tuple(ingest_counts(changes).first()) == (5, 2, 1)
    assert {row.dataset for row in stale_datasets(changes).collect()} == {
        "nh_ownership",
        "nh_penalties",
    }
    assert changed_dataset_files(changes, "nh_ownership") == ["/in/newer"]
    assert dataset_files(changes, "nh_ownership") == ["/in/newer", "/in/older", "/in/same"]

    done = state_rows(changed_files(routed, known), "bucket", "2024-01-03T00:00:00")
    after = upsert_state(known, done)
    assert after.count() == after.select("file_id").distinct().count() == 8
    again = changed_files(routed, after)
    assert {row.file_id for row in again.collect()} == {"no_time"}


def test_same_target_of_two_files_is_reported(spark):
    routed = route_files(listing(spark, ("1", OWNERSHIP, T1), ("2", OWNERSHIP, T1), ("3", PENALTIES, T1)))
    assert [tuple(row) for row in name_clashes(routed).collect()] == [
        (f"nh_ownership/{OWNERSHIP}", 2)
    ]


def test_state_log_keeps_the_last_version(spark, tmp_path):
    path = str(tmp_path / "state")
    assert read_state(spark, path).count() == 0
    routed = route_files(listing(spark, ("1", OWNERSHIP, T1), ("2", PENALTIES, T1)))
    record_state(state_rows(routed, "b", "2024-01-03T00:00:00"), path)
    newer = route_files(listing(spark, ("1", OWNERSHIP, T2)))
    record_state(state_rows(newer, "b", "2024-01-04T00:00:00"), path)
    rows = {row.file_id: row for row in read_state(spark, path).collect()}
    assert {name: row.modified_time for name, row in rows.items()} == {"1": T2, "2": T1}
    assert rows["1"].key == f"nh_ownership/{OWNERSHIP}"


def recorded(spark, name, time, day):
    routed = route_files(listing(spark, (name, OWNERSHIP, time)))
    return state_rows(routed, "b", f"2024-02-{day:02d}T00:00:00")


def test_state_log_is_folded_and_old_folders_go(spark, tmp_path):
    path = str(tmp_path / "state")
    for day in range(1, FOLD_AFTER + 3):
        record_state(recorded(spark, f"f{day % 5}", T1, day), path)
    table = StateTable(spark, path)
    snapshot, log = table.folders
    assert snapshot and len(log) == 2
    newest = {row.file_id: row.last_processed_at.day for row in table.read().collect()}
    assert newest == {f"f{day % 5}": day for day in range(FOLD_AFTER - 2, FOLD_AFTER + 3)}
    table.clean_up(keep=1)
    assert table.log.data_folders() == sorted([snapshot, *log])
    assert StateTable(spark, path).read().count() == 5


def test_readers_keep_to_their_version(spark, tmp_path):
    path = str(tmp_path / "state")
    record_state(recorded(spark, "a", T1, 1), path)
    reader = StateTable(spark, path)
    record_state(recorded(spark, "b", T1, 2), path)
    StateTable(spark, path).fold()
    assert [row.file_id for row in reader.read().collect()] == ["a"]
    assert {row.file_id for row in read_state(spark, path).collect()} == {"a", "b"}


def test_a_crash_between_two_steps_leaves_the_old_state(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "state")
    record_state(recorded(spark, "a", T1, 1), path)

    def crash(*_):
        raise OSError("lost")

    with monkeypatch.context() as patched:
        patched.setattr(VersionLog, "commit", crash)
        with pytest.raises(OSError):
            record_state(recorded(spark, "b", T1, 2), path)
    assert [row.file_id for row in read_state(spark, path).collect()] == ["a"]
    record_state(recorded(spark, "b", T1, 2), path)
    assert read_state(spark, path).count() == 2


def test_two_writers_at_once_lose_nothing(spark, tmp_path):
    path = str(tmp_path / "state")
    one, two = StateTable(spark, path), StateTable(spark, path)
    one.record(recorded(spark, "a", T1, 1))
    two.record(recorded(spark, "b", T1, 2))
    assert {row.file_id for row in read_state(spark, path).collect()} == {"a", "b"}
    with pytest.raises(VersionConflict):
        one.log.commit(one.version, {"snapshot": None, "log": []})
    # A fold that comes too late changes nothing.
    one.fold()
    assert read_state(spark, path).count() == 2


def test_what_is_recorded_later_wins_whatever_the_times_say(spark, tmp_path):
    path = str(tmp_path / "state")
    record_state(recorded(spark, "a", T2, 9), path)
    record_state(recorded(spark, "a", T1, 3), path)
    assert [row.modified_time for row in read_state(spark, path).collect()] == [T1]


def staffing_csv(rows):
    hours = (*HOURS, *EMPLOYEE_HOURS, *CONTRACTOR_HOURS)
    header = ",".join(["PROVNUM", "STATE", "WorkDate", "MDScensus", *hours])
    lines = [",".join([*row, *["1"] * len(hours)]) for row in rows]
    return "\n".join([header, *lines]) + "\n"


CLAIMS_CSV = (
    "CMS Certification Number (CCN),State,Measure Code,Measure Description,Resident Type,"
    "Measure Period,Adjusted Score,Processing Date\n"
    '015009,AL,521,"Rehospitalized, ""short"" stay",Short Stay,2023Q4,21.5,2024-09-01\n'
    '015009,AL,521,"Rehospitalized, ""short"" stay",Short Stay,2023Q4,22.5,2024-10-01\n'
    "015009,AL,551,Hospitalizations,Long Stay,2023Q4,N/A,2024-10-01\n"
)


@pytest.fixture
def folder(tmp_path):
    path = tmp_path / "incoming"
    path.mkdir()
    staffing = staffing_csv([("015009", "AL", "20240401", "4"), ("01E193", "AL", "20240401", "NA")])
    put(path, "PBJ_Daily_Nurse_Staffing_Q2_2024.csv", staffing, 1)
    put(path, "NH_QualityMsr_Claims_Oct2024.csv", CLAIMS_CSV, 1)
    put(path, "Something_Else.csv", "a\n1\n", 1)
    put(path, "notes.txt", "no table", 1)
    return path


def put(folder, name, text, day):
    path = folder / name
    path.write_text(text)
    seconds = dt.datetime(2024, 1, day, tzinfo=dt.UTC).timestamp()
    os.utime(path, (seconds, seconds))


def test_listing_shows_file_attributes_in_utc(spark, folder):
    df = list_files(spark, str(folder))
    rows = {row.file_name: row for row in df.collect()}
    assert len(rows) == 4
    assert rows["notes.txt"].modified_time == T1 and rows["notes.txt"].size == 8
    zone = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/Chicago")
    try:
        assert {row.modified_time for row in list_files(spark, str(folder)).collect()} == {T1}
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)
    assert "content" not in df._jdf.queryExecution().executedPlan().toString()


def test_incremental_run_end_to_end(spark, folder, tmp_path):
    state_path, refined = str(tmp_path / "state"), str(tmp_path / "refined")

    def run(ts, **options):
        return ingest(
            spark,
            list_files(spark, str(folder)),
            state_path,
            refined,
            prefix="raw",
            run_ts=ts,
            options=RefineOptions(**options),
        )

    first = run("2024-05-01T00:00:00+00:00")
    assert tuple(first.counts.first()) == (3, 0, 1)
    assert {row.dataset: row.status for row in first.results.collect()} == {
        STAFFING: "processed",
        CLAIMS: "processed",
    }
    report = register_views(spark, curated_views(refined))
    assert report.count() == 5
    load = spark.sql("select * from staffing_vs_patient_load order by provnum").collect()
    assert [tuple(row) for row in load] == [
        ("015009", "AL", 4.0, 8.0, 2.0),
        ("01E193", "AL", None, 8.0, None),
    ]
    scores = spark.table("staffing_levels_vs_readmission_rates").collect()
    assert [(r.provnum, r.measure_code, r.readmission_value) for r in scores] == [
        ("015009", 521, 22.5)
    ]
    assert scores[0].measure_description == 'Rehospitalized, "short" stay'

    second = run("2024-05-02T00:00:00+00:00")
    assert tuple(second.counts.first()) == (0, 3, 0)
    assert second.results.count() == 0

    # A changed file and a new one of the same dataset: all its files are read again.
    put(folder, "PBJ_Daily_Nurse_Staffing_Q2_2024.csv", staffing_csv([("015009", "AL", "20240401", "8")]), 2)
    put(folder, "PBJ_Daily_Nurse_Staffing_Q3_2024.csv", staffing_csv([("015009", "AL", "20240701", "4")]), 2)
    third = run("2024-05-03T00:00:00+00:00")
    assert tuple(third.counts.first()) == (2, 2, 0)
    assert [row.dataset for row in third.results.collect()] == [STAFFING]
    facts = read_refined(spark, refined, STAFFING)
    assert sorted((r.workdate, r.mdscensus) for r in facts.collect()) == [
        (20240401, 8),
        (20240701, 4),
    ]

    # With append only the new file's rows are added.
    put(folder, "PBJ_Daily_Nurse_Staffing_Q4_2024.csv", staffing_csv([("015009", "AL", "20241001", "2")]), 3)
    run("2024-05-04T00:00:00+00:00", mode="append")
    assert read_refined(spark, refined, STAFFING).count() == 3

    paths = write_views(
        read_refined(spark, refined, STAFFING),
        read_refined(spark, refined, CLAIMS),
        str(tmp_path / "curated"),
    )
    for name, path in paths.items():
        lazy = register_lazily(spark, refined, name)
        assert sorted(map(repr, spark.read.parquet(path).collect())) == lazy


def register_lazily(spark, refined, name):
    register_views(spark, {name: curated_views(refined)[name]})
    return sorted(map(repr, spark.table(name).collect()))


def test_a_failed_dataset_is_tried_again(spark, tmp_path):
    folder = tmp_path / "incoming"
    folder.mkdir()
    state_path, refined = str(tmp_path / "state"), str(tmp_path / "refined")
    put(folder, "PBJ_Daily_Nurse_Staffing_Q2_2024.csv", "PROVNUM,MDScensus\n1,many\n", 1)
    put(folder, OWNERSHIP, "k\n1\n", 1)
    arguments = (state_path, refined)
    with pytest.raises(RefineError):
        ingest(spark, list_files(spark, str(folder)), *arguments)
    assert [row.file_name for row in read_state(spark, state_path).collect()] == [OWNERSHIP]
    put(folder, "PBJ_Daily_Nurse_Staffing_Q2_2024.csv", "PROVNUM,MDScensus\n1,5\n", 1)
    run = ingest(spark, list_files(spark, str(folder)), *arguments)
    assert tuple(run.counts.first()) == (1, 1, 0)
    assert [row.dataset for row in run.results.collect()] == [STAFFING]


def test_odd_file_names_and_literals(spark, tmp_path):
    folder = tmp_path / "in coming"
    folder.mkdir()
    for i, name in enumerate(("NH_Ownership_(1) a.csv", "NH_Ownership_it's.csv", "NH_Ownership_%20.csv")):
        put(folder, name, f"k\n{i}\n", 1)
    state_path, refined = str(tmp_path / "state"), str(tmp_path / "refined")
    ingest(
        spark,
        list_files(spark, str(folder)),
        state_path,
        refined,
        bucket="o'b",
        prefix="/it's/",
        run_ts="2024-05-01T02:00:00+02:00",
    )
    assert sorted(r.k for r in read_refined(spark, refined, "nh_ownership").collect()) == [0, 1, 2]
    rows = read_state(spark, state_path).collect()
    assert {row.bucket for row in rows} == {"o'b"}
    assert {row.last_processed_at for row in rows} == {dt.datetime(2024, 5, 1)}
    assert all(row.key == f"it's/nh_ownership/{row.file_name}" for row in rows)


def test_views_are_built_in_order_up_to_the_first_failure(spark):
    built = []

    def good(name):
        def build(session):
            built.append(name)
            return session.range(3)

        return build

    def bad(session):
        raise KeyError("no such table")

    report = register_views(spark, {"v1": good("v1"), "empty": "  ", "v2": "select * from v1"})
    assert [tuple(row) for row in report.collect()] == [("v1", "SUCCEEDED"), ("v2", "SUCCEEDED")]
    assert spark.table("v2").count() == 3
    with pytest.raises(RuntimeError, match="view v4 failed"):
        register_views(spark, {"v3": good("v3"), "v4": bad, "v5": good("v5")})
    assert built == ["v1", "v3"]


def test_no_definitions(spark):
    assert register_views(spark, {}).count() == 0


def test_scratch_is_under_the_shared_folder(spark):
    base = spark.conf.get("spark.checkpoint.dir")
    one, two = scratch_path(spark, "x"), scratch_path(spark, "x")
    assert one.startswith(f"{base}/x-") and one != two
