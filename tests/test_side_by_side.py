"""Datasets refined side by side, each in a session of its own."""

import threading

import pytest

from carebase.datasets import pick_datasets
from carebase.plans import refine
from carebase.plans.refine import RefineError, RefineOptions, refine_all, refine_sources
from carebase.session import own_session, side_by_side
from carebase.sources.refined import read_refined

PARTITIONS = "spark.sql.shuffle.partitions"


def put(root, dataset, *lines):
    folder = root / dataset
    folder.mkdir(parents=True)
    (folder / "a.csv").write_text("\n".join(["Key,Some Value", *lines]) + "\n")


def test_all_datasets_in_one_run_in_their_order(spark, tmp_path):
    names = pick_datasets(None)
    for i, name in enumerate(names):
        put(tmp_path / "raw", name, *(f"{k},{i}" for k in range(3)), f"0,{i}")
    options = RefineOptions(types={}, at_once=7)
    rows = refine_all(spark, str(tmp_path / "raw"), str(tmp_path / "out"), options=options).collect()
    assert [row.dataset for row in rows] == list(names) and len(rows) == 21
    assert {(row.status, row.rows_in, row.rows_out) for row in rows} == {("processed", 4, 3)}
    for i, name in enumerate(names):
        stored = read_refined(spark, str(tmp_path / "out"), name)
        assert sorted((r.key, r.some_value) for r in stored.collect()) == [(k, i) for k in range(3)]


def test_datasets_overlap_and_one_failure_stays_alone(spark, tmp_path, monkeypatch):
    names = ["nh_ownership", "nh_penalties", "nh_survey_dates"]
    for name in names:
        put(tmp_path / "raw", name, "1,2")
    together, real = threading.Barrier(len(names)), refine.refine_paths

    def waits_for_the_others(session, paths, dataset, *args):
        together.wait(timeout=60)
        if dataset == "nh_penalties":
            raise ValueError("broken")
        return real(session, paths, dataset, *args)

    monkeypatch.setattr(refine, "refine_paths", waits_for_the_others)
    with pytest.raises(RefineError) as error:
        refine_all(spark, str(tmp_path / "raw"), str(tmp_path / "out"), names)
    found = [(row["dataset"], row["status"]) for row in error.value.results]
    assert found == list(zip(names, ["processed", "failed", "processed"], strict=True))
    assert read_refined(spark, str(tmp_path / "out"), names[2]).count() == 1


def test_settings_stay_in_their_session(spark, monkeypatch):
    seen, before = {}, spark.conf.get(PARTITIONS)

    def sets_its_own(session, paths, dataset, *args):
        seen[dataset] = session.conf.get(PARTITIONS), session.sparkContext.getLocalProperty("spark.scheduler.pool")
        session.conf.set(PARTITIONS, int(paths))
        assert session.range(1).count() == 1
        return {"dataset": dataset, "status": session.conf.get(PARTITIONS)}

    monkeypatch.setattr(refine, "refine_paths", sets_its_own)
    spark.conf.set(PARTITIONS, 11)
    try:
        sources = {"a": "101", "b": "102", "c": "103"}
        results = refine_sources(spark, sources, "out", options=RefineOptions(at_once=2))
        assert [row["status"] for row in results] == ["101", "102", "103"]
        assert seen == {name: ("11", name) for name in sources}
        assert spark.conf.get(PARTITIONS) == "11"
        assert spark.sparkContext.getLocalProperty("spark.scheduler.pool") is None
    finally:
        spark.conf.set(PARTITIONS, before)


def test_never_more_than_asked_for(spark):
    running, most, lock = set(), [], threading.Lock()

    def work(name):
        def run(session):
            with lock:
                running.add(name)
                most.append(len(running))
            session.range(10).count()
            with lock:
                running.remove(name)
            return name

        return run

    names = [f"n{i}" for i in range(6)]
    assert side_by_side(spark, {name: work(name) for name in names}, 2) == names
    assert max(most) <= 2
    assert side_by_side(spark, {}, 2) == []
    with pytest.raises(ValueError):
        RefineOptions(at_once=0)


def test_a_session_of_its_own_starts_with_the_same_settings(spark):
    session = own_session(spark)
    for name in (PARTITIONS, "spark.sql.session.timeZone", "spark.checkpoint.dir"):
        assert session.conf.get(name) == spark.conf.get(name)
