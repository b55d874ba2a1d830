"""Types found by an aggregate over text, beside Spark's own inference."""

import csv

import pytest

from carebase.plans.refine import RefineOptions, refine_all
from carebase.sources.inference import SchemaRegistry, as_types, stored_as_text, type_of, types_of
from carebase.sources.raw import with_file
from carebase.sources.refined import read_refined

OTHER = "nh_provider_info"
COLUMNS = [
    ["1", "2"], ["1", "3000000000"], ["1", "12345678901234567890"], ["5000000000", "9999999999999999999"],
    ["1", "1.5"], ["1e5", "2"], ["NaN", "1"], ["Inf", "-Inf"], ["Infinity", "1"], ["1f", "2"], ["1d", ".5"],
    ["5.5", "+7"], ["2024-01-01", "2024-02-03"], ["2024-1-1", "2024-02-03"], ["2024-01", "2024-02"],
    ["2024-01-01 10:00:00", "2024-01-01 11:00"], ["2024-01-01", "2024-01-01 11:00:00"],
    ["2024-01-01T10:00:00Z", "2024-01-01T10:00:00Z"], ["2024-13-01", "2024-01-01"], ["20240101", "20240102"],
    ["true", "FALSE"], ["true", "1"], ["true ", "false"], ["2024-01-01", "5"], [" 1", "2"], ["1 ", "2"],
    ["N/A", "2"], ["01", "002"], ["10:30", "11:30"], ["1,5", "2"], ["0x1", "2"], ["1e400", "2"],
    ["123456789012345678901234567890123456789", "1"], ["-", "1"], ["1_000", "2"], ["2024-01-01 ", "2024-01-01"],
    ["10/27/2024", "10/28/2024"], ["", "3"], ["", ""], ["a", ""], ["-0", "0.0"], ["é", "1"],
]


def test_types_and_values_are_those_of_spark(spark, tmp_path):
    path = str(tmp_path / "a.csv")
    with open(path, "w", newline="") as file:
        writer = csv.writer(file)
        writer.writerow([f"n{i}" for i in range(len(COLUMNS))])
        writer.writerows(zip(*COLUMNS, strict=True))
    theirs = spark.read.csv(path, header=True, inferSchema=True, escape='"')
    stored, bits = stored_as_text(with_file(spark.read.csv(path, header=True, escape='"'), "file"))
    ours = as_types(stored, types_of(bits)).drop(stored.columns[-1])
    types = {name: (kind, cells) for (name, kind), cells in zip(theirs.dtypes, COLUMNS, strict=True)}
    assert {n: (k, types[n][1]) for n, k in ours.dtypes} == types
    assert sorted(map(repr, ours.collect())) == sorted(map(repr, theirs.collect()))


def test_ids_stay_text_and_kinds_combine_in_any_order():
    assert types_of({"Provnum": 1, "n": 1}) == {"Provnum": "string", "n": "int"}
    for a in (1, 2, 4, 8, 16, 32, 64, 1 << 7, 1 << 26):
        assert type_of(a | 64) == "string" and type_of(0) == "string"
    assert type_of(1 << 7) == "decimal(19,0)" and type_of(1 << 26 | 1) == "decimal(38,0)"
    assert type_of(1 << 7 | 2) == "decimal(20,0)" and type_of(1 << 7 | 4) == "double"


def run(spark, tmp_path, mode="overwrite", fail_on_error=True):
    options = RefineOptions(mode=mode)
    roots = (str(tmp_path / "raw"), str(tmp_path / "refined"))
    return refine_all(spark, *roots, OTHER, options=options, fail_on_error=fail_on_error).first()


def put(tmp_path, name, text):
    folder = tmp_path / "raw" / OTHER
    folder.mkdir(parents=True, exist_ok=True)
    (folder / name).write_text(text)


def test_drift_is_reported_by_column(spark, tmp_path):
    put(tmp_path, "a.csv", "k,v,w\n1,2,x\n")
    assert run(spark, tmp_path).reason is None
    put(tmp_path, "b.csv", "k,v,w\n1.5,2,x\n")
    assert run(spark, tmp_path).reason == "types changed: k: int to double"
    assert dict(read_refined(spark, str(tmp_path / "refined"), OTHER).dtypes)["k"] == "double"
    assert run(spark, tmp_path).reason is None
    # The next files alone would give an int; the dataset as a whole has doubles.
    (tmp_path / "raw" / OTHER / "b.csv").write_text("k,v,w\n7,8,x\n")
    row = run(spark, tmp_path, mode="append")
    assert (row.status, row.reason) == ("processed", None)
    assert sorted(r.k for r in read_refined(spark, str(tmp_path / "refined"), OTHER).collect()) == [1, 1, 1.5, 7]
    registry = SchemaRegistry(spark, str(tmp_path / "refined"), OTHER)
    assert types_of(registry.bits()) == {"k": "double", "v": "int", "w": "string"}


def test_a_failed_run_leaves_the_registry(spark, tmp_path):
    put(tmp_path, "a.csv", "k\n1\n")
    run(spark, tmp_path)
    put(tmp_path, "a.csv", "k\nx\n")
    assert run(spark, tmp_path, mode="append", fail_on_error=False).status == "failed"
    registry = SchemaRegistry(spark, str(tmp_path / "refined"), OTHER)
    assert types_of(registry.bits()) == {"k": "int"}


def test_files_are_read_once(spark, tmp_path, monkeypatch):
    put(tmp_path, "a.csv", "k\n1\n")
    scans = []
    monkeypatch.setattr(
        "carebase.plans.refine.scan_csv",
        lambda *args, **more: scans.append(more["infer"]) or spark.read.csv(args[1], header=True),
    )
    assert run(spark, tmp_path).rows_out == 1
    assert scans == [False]


@pytest.mark.parametrize("text", ["k,k,\n1,2,3\n", "__file,a b;c\n1,2\n"])
def test_odd_column_names(spark, tmp_path, text):
    put(tmp_path, "a.csv", text)
    assert run(spark, tmp_path).status == "processed"
