"""Files copied under the landing root, whole or not at all."""

import datetime as dt
import json
import os

import pytest

from carebase.datasets import ROUTES
from carebase.operators.state import read_state
from carebase.plans.ingest import ingest
from carebase.plans.refine import RefineOptions
from carebase.sources import landing
from carebase.sources.landing import LandingWriter, finish_earlier_runs, land, locate, publish
from carebase.sources.listing import list_files
from carebase.sources.refined import read_refined

T1, T2 = dt.datetime(2024, 1, 1), dt.datetime(2024, 1, 2)
FILES = "file_id string, path string, target_path string, modified_time timestamp_ntz"
OWNERSHIP, PENALTIES = "nh_ownership", "nh_penalties"


def put(folder, name, text, day=1):
    folder.mkdir(parents=True, exist_ok=True)
    path = folder / name
    path.write_text(text)
    seconds = dt.datetime(2024, 1, day, tzinfo=dt.UTC).timestamp()
    os.utime(path, (seconds, seconds))
    return str(path)


def tree(root):
    return {
        str(path.relative_to(root)): path.read_text() for path in root.rglob("*.csv") if path.is_file()
    }


def test_files_of_any_size_land_whole(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(landing, "BLOCK_BYTES", 10)
    texts = {f"f{i} ä%20.csv": f"k\n{i}\n" * i * 7 for i in range(30)}
    rows = [
        (name, "file:" + put(tmp_path / "in", name, text), f"raw/{i % 3}/{name}", T1)
        for i, (name, text) in enumerate(texts.items())
    ]
    # Spark writes URIs with escapes.
    rows = [(n, p.replace("%", "%25").replace(" ", "%20"), t, m) for n, p, t, m in rows]
    root = tmp_path / "lake"
    n, size = land(spark.createDataFrame(rows, FILES), str(root))
    assert (n, size) == (30, sum(len(text.encode()) for text in texts.values()))
    assert tree(root) == {f"raw/{i % 3}/{name}": text for i, (name, text) in enumerate(texts.items())}
    assert list((root / "_landing").iterdir()) == []


def test_newest_of_equal_targets_wins(spark, tmp_path):
    paths = [put(tmp_path / "in", f"{i}.csv", str(i)) for i in range(3)]
    times = (T2, T1, T2)
    rows = [(f"id{i}", path, "a/x.csv", times[i]) for i, path in enumerate(paths)]
    assert land(spark.createDataFrame(rows, FILES), str(tmp_path / "lake"))[0] == 1
    assert tree(tmp_path / "lake") == {"a/x.csv": "2"}


def test_nothing_to_land(spark, tmp_path):
    assert land(spark.createDataFrame([], FILES), str(tmp_path / "lake")) == (0, 0)


def test_a_file_that_cannot_be_read_leaves_nothing_behind(spark, tmp_path):
    good = put(tmp_path / "in", "good.csv", "k\n1\n")
    rows = [("1", good, "a/good.csv", T1), ("2", str(tmp_path / "in/absent.csv"), "a/absent.csv", T1)]
    root = tmp_path / "lake"
    put(root / "a", "good.csv", "old")
    with pytest.raises(Exception, match="absent"):
        land(spark.createDataFrame(rows, FILES), str(root))
    assert tree(root) == {"a/good.csv": "old"}
    finish_earlier_runs(spark, str(root))
    assert tree(root) == {"a/good.csv": "old"}


class File:
    def __init__(self, file_id, path, target_path):
        self.file_id, self.path, self.target_path = file_id, path, target_path


def staged(tmp_path, run, *files):
    """What one task leaves when it has written ``files`` and nothing was committed yet."""
    writer = LandingWriter(str(tmp_path / "lake"), run)
    return writer, writer.write(iter(files))


def test_parts_of_lost_and_repeated_tasks_do_not_count(spark, tmp_path):
    root, source = tmp_path / "lake", put(tmp_path / "in", "x.csv", "new")
    writer, lost = staged(tmp_path, "run", File("1", source, "a/lost.csv"))
    _, counted = staged(tmp_path, "run", File("1", source, "a/x.csv"))
    writer.commit([counted, None])
    assert tree(root) == {}
    assert publish(spark, str(root), "run") == (1, 3)
    assert tree(root) == {"a/x.csv": "new"} and lost.name != counted.name


def test_a_crash_before_the_commit_changes_nothing(spark, tmp_path):
    put(tmp_path / "lake/a", "x.csv", "old")
    staged(tmp_path, "run", File("1", put(tmp_path / "in", "x.csv", "new"), "a/x.csv"))
    finish_earlier_runs(spark, str(tmp_path / "lake"))
    assert tree(tmp_path / "lake") == {"a/x.csv": "old"}


def test_a_crash_after_the_commit_is_finished_by_the_next_run(spark, tmp_path):
    root = tmp_path / "lake"
    put(root / "a", "x.csv", "old")
    files = [File(n, put(tmp_path / "in", n, f"new {n}"), f"a/{n}") for n in ("x.csv", "y.csv")]
    writer, part = staged(tmp_path, "run", *files)
    writer.commit([part])
    # One of the renames had been done already.
    lines = [json.loads(line) for line in (root / "_landing/run" / part.name).read_text().splitlines()]
    os.replace(root / "_landing/run" / lines[1]["staged"], root / "a/y.csv")
    assert tree(root) == {"a/x.csv": "old", "a/y.csv": "new y.csv"}
    finish_earlier_runs(spark, str(root))
    assert tree(root) == {"a/x.csv": "new x.csv", "a/y.csv": "new y.csv"}
    assert list((root / "_landing").iterdir()) == []


def test_a_staged_file_that_is_gone_fails_the_run(spark, tmp_path):
    writer, part = staged(tmp_path, "run", File("1", put(tmp_path / "in", "x.csv", "new"), "a/x.csv"))
    writer.commit([part])
    for path in (tmp_path / "lake/_landing/run/files").iterdir():
        os.replace(path, tmp_path / "elsewhere")
    with pytest.raises(Exception, match="neither staged nor landed"):
        publish(spark, str(tmp_path / "lake"), "run")


def test_uris():
    assert locate("/a b/c%20.csv")[1] == "/a b/c%20.csv"
    assert locate("file:/a%20b/c%2520.csv")[1] == "/a b/c%20.csv"
    assert locate("file:///a/b.csv")[1] == "/a/b.csv"


def run_ingest(spark, tmp_path, day, **options):
    return ingest(
        spark,
        list_files(spark, str(tmp_path / "inbox")),
        str(tmp_path / "state"),
        str(tmp_path / "refined"),
        landing_root=str(tmp_path / "lake"),
        prefix="raw",
        run_ts=f"2024-05-{day:02d}T00:00:00+00:00",
        options=RefineOptions(**options),
    )


def rows_of(spark, tmp_path, dataset):
    rows = read_refined(spark, str(tmp_path / "refined"), dataset).collect()
    return sorted((row.k, row.source_file.rpartition("/")[2]) for row in rows)


def test_rounds_with_removed_changed_and_added_files(spark, tmp_path):
    inbox, lake = tmp_path / "inbox", tmp_path / "lake"
    gone = put(inbox, "NH_Ownership_A.csv", "k\n1\n")
    put(inbox, "NH_Ownership_B.csv", "k\n2\n")
    put(inbox, "Odd.csv", "k\n9\n")
    put(inbox, "readme.txt", "no")
    first = run_ingest(spark, tmp_path, 1)
    assert tuple(first.counts.first()) == (3, 0, 1)
    assert tree(lake) == {
        "raw/nh_ownership/NH_Ownership_A.csv": "k\n1\n",
        "raw/nh_ownership/NH_Ownership_B.csv": "k\n2\n",
        "raw/_unmapped/Odd.csv": "k\n9\n",
    }
    assert {row.key for row in read_state(spark, str(tmp_path / "state")).collect()} == set(tree(lake))

    os.replace(gone, tmp_path / "gone.csv")
    put(inbox, "NH_Ownership_B.csv", "k\n3\n", day=2)
    put(inbox, "NH_Ownership_C.csv", "k\n4\n", day=2)
    put(inbox, "Odd.csv", "k\n8\n", day=2)
    second = run_ingest(spark, tmp_path, 2)
    assert tuple(second.counts.first()) == (3, 0, 1)
    assert rows_of(spark, tmp_path, OWNERSHIP) == [
        (1, "NH_Ownership_A.csv"),
        (3, "NH_Ownership_B.csv"),
        (4, "NH_Ownership_C.csv"),
    ]
    assert tree(lake)["raw/_unmapped/Odd.csv"] == "k\n8\n"

    put(inbox, "NH_Ownership_D.csv", "k\n5\n", day=3)
    run_ingest(spark, tmp_path, 3, mode="append")
    assert len(rows_of(spark, tmp_path, OWNERSHIP)) == 4
    third = run_ingest(spark, tmp_path, 4)
    assert tuple(third.counts.first()) == (0, 4, 0) and third.results.count() == 0
    assert PENALTIES in ROUTES
