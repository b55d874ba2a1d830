"""View definitions stored beside the data and replayed in other sessions."""

import pytest

from carebase import fixtures
from carebase.datasets import CLAIMS, STAFFING
from carebase.jobs import main
from carebase.plans.view_store import ViewStore, curated_sql, store_curated_views
from carebase.plans.views import curated_views
from carebase.sources.refined import write_refined
from carebase.sources.versions import VersionConflict

DATA = "/root/testdata/sf0.001"
LOAD, SCORES = ("provnum", "state"), ("row_id",)


@pytest.fixture(scope="module")
def refined(spark, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("refined"))
    write_refined(fixtures.staffing(spark, DATA), root, STAFFING)
    write_refined(fixtures.claims(spark, DATA), root, CLAIMS)
    return root


def rows(df):
    return sorted(map(repr, df.collect()))


def test_another_session_reads_all_five(spark, refined, tmp_path):
    store_curated_views(spark, str(tmp_path / "store"), refined, LOAD, SCORES)
    other = spark.newSession()
    report = ViewStore(other, str(tmp_path / "store")).replay()
    expected = curated_views(refined, LOAD, SCORES)
    assert [tuple(row) for row in report.collect()] == [(name, "SUCCEEDED") for name in expected]
    for name, build in expected.items():
        frame = build(spark)
        view = other.table(name)
        assert view.columns == frame.columns and view.dtypes == frame.dtypes
        assert rows(view) == rows(frame), name
        assert view.count() > 0


@pytest.mark.parametrize("slices", [1, 3])
def test_slices_change_nothing(spark, refined, tmp_path, slices):
    name = "staffing_levels_vs_readmission_rates"
    store = ViewStore(spark.newSession(), str(tmp_path / "store"))
    store.replace(curated_sql(LOAD, SCORES, slices), refined)
    store.replay()
    assert rows(store.spark.table(name)) == rows(curated_views(refined, LOAD, SCORES)[name](spark))


def test_a_bad_definition_leaves_the_old_one(spark, refined, tmp_path):
    session = spark.newSession()
    store = ViewStore(session, str(tmp_path / "store"))
    store.replace({"one": "SELECT 1 AS a", "two": "SELECT a + 1 AS b FROM one"}, refined)
    with pytest.raises(RuntimeError, match="view one failed"):
        store.replace({"one": "SELECT FROM"})
    # Valid by itself, but the view that reads it is not any more.
    with pytest.raises(RuntimeError, match="view two failed"):
        store.replace({"one": "SELECT 1 AS z"})
    store.replay()
    assert session.table("two").first().b == 2
    store.replace({"one": "SELECT 5 AS a"})
    assert list(store.definitions()) == ["one", "two"]
    store.replay()
    assert session.table("two").first().b == 6


def test_blank_definitions_leave_a_view_out(spark, refined, tmp_path):
    store = ViewStore(spark.newSession(), str(tmp_path / "store"))
    store.replace({"one": "SELECT 1 AS a", "none": "  ", "nothing": None}, refined)
    assert list(store.definitions()) == ["one"]
    assert store.replace({"one": ""}) == {}


def test_an_empty_store(spark, tmp_path):
    store = ViewStore(spark, str(tmp_path / "store"))
    assert store.definitions() == {} and store.replay().count() == 0
    with pytest.raises(ValueError, match="root"):
        store.replace({"one": "SELECT 1"})


def test_two_writers_at_once(spark, refined, tmp_path):
    store = ViewStore(spark, str(tmp_path / "store"))
    base = store.log.latest()
    store.replace({"one": "SELECT 1 AS a"}, refined)
    with pytest.raises(VersionConflict):
        store.log.commit(base, {"views": []})
    assert list(store.definitions()) == ["one"]


def test_a_table_that_has_gone_stops_the_replay(spark, refined, tmp_path):
    store = ViewStore(spark, str(tmp_path / "store"))
    store.log.commit(None, {"root": str(tmp_path), "tables": ["none"], "views": [["v", "SELECT 1"]]})
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        store.replay(spark.newSession())


def test_the_job_stores_them(spark, refined, tmp_path, capsys):
    main(["register", "--refined", refined, "--store", str(tmp_path / "store")], spark)
    assert "total_nurse_hours" in capsys.readouterr().out
    assert len(ViewStore(spark, str(tmp_path / "store")).definitions()) == 5
