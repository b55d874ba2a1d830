"""Raw CSV to Parquet, with the odd cases of real folders."""

import gzip

import pytest
from pyspark.errors import PySparkException

from carebase.datasets import CLAIMS, DATASETS, HOURS, STAFFING
from carebase.operators.cleaning import standardize_missing
from carebase.operators.dedupe import dedupe_report, drop_duplicates
from carebase.plans.refine import RefineError, RefineOptions, refine_all
from carebase.session import shuffle_partitions_for
from carebase.sources.raw import header_groups, is_missing_source, scan_csv
from carebase.sources.refined import read_refined, register_refined

OTHER = "nh_provider_info"


def put(root, dataset, **files):
    folder = root / dataset
    folder.mkdir(parents=True, exist_ok=True)
    for name, text in files.items():
        (folder / f"{name}.csv").write_text(text)
    return folder


@pytest.fixture
def roots(tmp_path):
    return tmp_path / "raw", tmp_path / "refined"


def run(spark, roots, datasets, fail_on_error=True, run_ts="2024-05-01T00:00:00+00:00", **options):
    raw, refined = map(str, roots)
    results = refine_all(
        spark,
        raw,
        refined,
        datasets,
        run_ts=run_ts,
        fail_on_error=fail_on_error,
        options=RefineOptions(**options),
    )
    return {row.dataset: row for row in results.collect()}


def refined(spark, roots, dataset):
    return read_refined(spark, str(roots[1]), dataset)


def test_csv_with_quotes_breaks_and_messy_headers(spark, roots):
    put(roots[0], OTHER, a='Provider Name,A/B - C,%%\n"x ""y""\nz", TX ,1\n"p,q",N/A,2\n')
    row = run(spark, roots, OTHER)[OTHER]
    assert (row.status, row.rows_in, row.rows_out, row.duplicates) == ("processed", 2, 2, 0)
    assert row.refined_path == f"{roots[1]}/{OTHER}"
    df = refined(spark, roots, OTHER)
    assert df.columns == ["provider_name", "a_b_c", "col", "source_file", "ingested_at_utc"]
    rows = sorted(df.collect())
    assert [tuple(r)[:3] for r in rows] == [("p,q", None, 2), ('x "y"\nz', " TX ", 1)]
    assert all(r.source_file.endswith("/a.csv") for r in rows)
    assert {r.ingested_at_utc for r in rows} == {"2024-05-01T00:00:00+00:00"}


def test_equal_rows_in_one_file_and_in_two(spark, roots):
    put(roots[0], OTHER, a="k,v\n1,NA\n1,n/a\n2,x\n", b="k,v\n1,\n")
    row = run(spark, roots, OTHER)[OTHER]
    assert (row.rows_in, row.rows_out, row.duplicates) == (4, 3, 1)
    row = run(spark, roots, OTHER, ignore_lineage=True)[OTHER]
    assert (row.rows_in, row.rows_out, row.duplicates) == (4, 2, 2)
    rows = sorted(refined(spark, roots, OTHER).collect())
    assert [(r.k, r.v, r.source_file[-5:]) for r in rows] == [(1, None, "a.csv"), (2, "x", "a.csv")]


def test_append_adds_and_overwrite_replaces(spark, roots):
    put(roots[0], OTHER, a="k\n1\n")
    run(spark, roots, OTHER, run_ts="first")
    run(spark, roots, OTHER, run_ts="second", mode="APPEND")
    assert refined(spark, roots, OTHER).count() == 2
    run(spark, roots, OTHER, run_ts="third")
    assert [r.ingested_at_utc for r in refined(spark, roots, OTHER).collect()] == ["third"]


def test_declared_types_keep_ids_and_cast_by_name(spark, roots):
    hours = ",".join(name.replace("hrs_", "Hrs_") for name in HOURS)
    ones = ",".join("1.5" for _ in HOURS)
    put(
        roots[0],
        STAFFING,
        a=f"PROVNUM,STATE,COUNTY_FIPS,WorkDate,MDScensus,{hours}\n"
        f"015009,AL,049,20240401,51,{ones}\n01519F,AL,001,20240402,NA,{ones}\n",
    )
    put(
        roots[0],
        CLAIMS,
        a="CMS Certification Number (CCN),State,Measure Code,Adjusted Score,Processing Date\n"
        "01E193,AL,521,N/A,2024-10-01\n",
    )
    run(spark, roots, [STAFFING, CLAIMS])
    facts = refined(spark, roots, STAFFING)
    types = dict(facts.dtypes)
    assert {types[name] for name in HOURS} == {"double"}
    assert (types["provnum"], types["county_fips"], types["workdate"]) == ("string", "string", "int")
    assert sorted((r.provnum, r.county_fips, r.mdscensus) for r in facts.collect()) == [
        ("015009", "049", 51),
        ("01519F", "001", None),
    ]
    claim = refined(spark, roots, CLAIMS).first()
    assert claim.cms_certification_number_ccn == "01E193"
    assert (claim.measure_code, claim.adjusted_score) == (521, None)
    assert str(claim.processing_date) == "2024-10-01"


def test_inferred_datasets_keep_ids_too(spark, roots):
    put(
        roots[0],
        OTHER,
        a="CMS Certification Number (CCN),Beds,Rating\n015009,10,N/A\n01E193,20,4\n",
    )
    run(spark, roots, OTHER)
    df = refined(spark, roots, OTHER)
    types = dict(df.dtypes)
    assert types["cms_certification_number_ccn"] == "string" and types["beds"] == "int"
    # A token among numbers makes inference settle on text; it stays text after cleaning.
    assert types["rating"] == "string"
    assert sorted(tuple(r)[:3] for r in df.collect()) == [("015009", 10, None), ("01E193", 20, "4")]


def test_bad_values_fail_or_are_counted(spark, roots):
    put(roots[0], STAFFING, a="PROVNUM,MDScensus\n1,many\n1,many\n1,NA\n2,5\n")
    row = run(spark, roots, STAFFING, fail_on_error=False)[STAFFING]
    assert row.status == "failed" and "CAST_INVALID_INPUT" in row.reason
    row = run(spark, roots, STAFFING, on_bad_value="null")[STAFFING]
    assert (row.rows_in, row.rows_out, row.bad_cells) == (4, 2, 2)


def test_missing_sources_are_skipped(spark, roots):
    (roots[0] / "empty_folder").mkdir(parents=True)
    put(roots[0], "no_bytes", a="")
    put(roots[0], "good", a="k\n1\n")
    names = "absent, empty_folder, no_bytes, good/"
    rows = run(spark, roots, names)
    assert {name: row.status for name, row in rows.items()} == {
        "absent": "skipped_missing",
        "empty_folder": "skipped_missing",
        "no_bytes": "skipped_missing",
        "good": "processed",
    }
    assert rows["no_bytes"].reason == "no columns"
    strict = run(spark, roots, names, fail_on_error=False, skip_missing=False)
    assert [row.status for row in strict.values()] == ["failed"] * 3 + ["processed"]


def test_one_failure_does_not_stop_the_rest(spark, roots):
    put(roots[0], STAFFING, a="PROVNUM,MDScensus\n1,many\n")
    put(roots[0], OTHER, a="k\n1\n")
    with pytest.raises(RefineError, match=STAFFING) as caught:
        run(spark, roots, [STAFFING, OTHER])
    assert [row["status"] for row in caught.value.results] == ["failed", "processed"]
    assert refined(spark, roots, OTHER).count() == 1


def test_all_known_datasets_by_default(spark, roots):
    put(roots[0], OTHER, a="k\n1\n")
    rows = run(spark, roots, None)
    assert list(rows) == list(DATASETS)
    assert [name for name, row in rows.items() if row.status == "processed"] == [OTHER]


def test_header_only_file(spark, roots):
    put(roots[0], OTHER, a="k,v\n")
    row = run(spark, roots, OTHER)[OTHER]
    assert (row.status, row.rows_in, row.rows_out) == ("processed", 0, 0)
    assert refined(spark, roots, OTHER).columns[:2] == ["k", "v"]


def test_header_off_and_other_separator(spark, roots):
    put(roots[0], OTHER, a="1|x\n2|y\n")
    run(spark, roots, OTHER, header=False, sep="|")
    assert refined(spark, roots, OTHER).columns[:2] == ["c0", "c1"]


def test_names_that_clash_with_lineage_or_each_other(spark, roots):
    put(roots[0], OTHER, a="a,A,Source File,,x,x-,x_2\n1,2,s,3,4,5,6\n")
    run(spark, roots, OTHER)
    # Spark's reader itself tells headers apart that are equal up to case, or blank.
    assert refined(spark, roots, OTHER).columns == [
        "a0",
        "a1",
        "source_file",
        "c3",
        "x",
        "x_2",
        "x_2_2",
        "source_file_2",
        "ingested_at_utc",
    ]


def test_header_named_like_the_metadata_column(spark, roots):
    put(roots[0], OTHER, a="_metadata,k.x\n1,2\n")
    run(spark, roots, OTHER)
    row = refined(spark, roots, OTHER).first()
    assert (row.metadata, row.kx) == (1, 2) and row.source_file.endswith("/a.csv")


def test_single_line_files_are_split(spark, roots):
    folder = put(roots[0], OTHER, a="k,v\n" + "".join(f"{i},x\n" for i in range(20000)))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "32k")
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    try:
        whole = scan_csv(spark, str(folder), infer=False)
        split = scan_csv(spark, str(folder), infer=False, multi_line=False)
        assert whole.rdd.getNumPartitions() == 1 < split.rdd.getNumPartitions()
        assert split.count() == 20000
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")
    row = run(spark, roots, OTHER, single_line=frozenset([OTHER]))[OTHER]
    assert row.rows_out == 20000


@pytest.mark.parametrize(
    "text",
    [
        "a,b\r\n1,x\n2,y\r\n",
        "a,b\n1,x\r\n2,y\n3,z\r\n",
        "a,b\n1,x\n\r\n2,y\n",
        'a,b\n1,"x, ""y"""\n2,"line\nbreak"\n',
    ],
)
def test_the_same_lines_give_the_same_rows_at_any_size(spark, roots, text):
    small = put(roots[0], OTHER, a=text)
    rows = scan_csv(spark, str(small), infer=False).collect()
    end = "\r\n" if text.startswith("a,b\r") else "\n"
    padded = put(roots[0], "padded", a=text + f"9,9{end}" * 20001)
    large = scan_csv(spark, str(padded), infer=False).collect()
    assert large[: len(rows) - 1] == rows[:-1]
    assert len(large) >= len(rows) + 20000


def test_declared_single_lines_give_equal_results(spark, roots):
    lines = [f'{i % 900},"x, ""{i % 900}"""' for i in range(3000)]
    put(roots[0], OTHER, a="k,v\n" + "\n".join(lines) + "\n", b="k,v\n1,y\n")
    sizes = [path.stat().st_size for path in (roots[0] / OTHER).iterdir()]
    assert header_groups(spark, str(roots[0] / OTHER)).total == sum(sizes)
    counts = []
    for single in (frozenset(), frozenset({OTHER})):
        row = run(spark, roots, OTHER, single_line=single)[OTHER]
        df = refined(spark, roots, OTHER)
        counts.append((row.rows_in, row.rows_out, sorted(map(tuple, df.collect()))))
    assert counts[0] == counts[1]
    assert counts[0][:2] == (3001, 901)


def test_appending_other_types_fails_before_writing(spark, roots):
    put(roots[0], OTHER, a="k\n1\n")
    run(spark, roots, OTHER, mode="append")
    (roots[0] / OTHER / "a.csv").write_text("k\nx7\n")
    assert run(spark, roots, OTHER, mode="append", fail_on_error=False)[OTHER].status == "failed"
    assert [r.k for r in refined(spark, roots, OTHER).collect()] == [1]


def test_files_of_different_headers_are_united_by_name(spark, roots):
    put(roots[0], OTHER, a="p,q\n1,2\n", b="Q,p ,r\n20,10,5\n", c="")
    put(roots[0], STAFFING, a="PROVNUM,MDScensus\n1,5\n", b="MDScensus,X,PROVNUM\n7,y,02\n")
    rows = run(spark, roots, [OTHER, STAFFING])
    assert (rows[OTHER].rows_in, rows[OTHER].rows_out) == (2, 2)
    df = refined(spark, roots, OTHER)
    assert df.columns == ["p", "q", "r", "source_file", "ingested_at_utc"]
    assert sorted((r.p, r.q, r.r, r.source_file[-5:]) for r in df.collect()) == [
        (1, 2, None, "a.csv"),
        (10, 20, 5, "b.csv"),
    ]
    facts = refined(spark, roots, STAFFING)
    assert dict(facts.dtypes)["mdscensus"] == "double"
    assert sorted((r.provnum, r.mdscensus, r.x) for r in facts.collect()) == [("02", 7.0, "y"), ("1", 5.0, None)]


def test_names_that_look_numbered_are_united_by_name(spark, roots):
    put(roots[0], OTHER, a="q0,q1\n1,2\n", b="q1,q0,r\n20,10,5\n")
    run(spark, roots, OTHER)
    df = refined(spark, roots, OTHER)
    assert sorted((r.q0, r.q1, r.r) for r in df.collect() if r.r) == [(10, 20, 5)]
    assert sorted((r.q0, r.q1) for r in df.collect() if not r.r) == [(1, 2)]


def test_blank_and_repeated_names_in_several_files(spark, roots):
    put(roots[0], OTHER, a="a,,a\n1,2,3\n", b="a,,a\n4,5,6\n", c="z,a,,a\n0,7,8,9\n")
    run(spark, roots, OTHER)
    rows = refined(spark, roots, OTHER).collect()
    # Spark numbers such names by position, so files of another layout have columns of their own.
    assert sorted((r.a0, r.c1, r.a2) for r in rows if r.z is None) == [(1, 2, 3), (4, 5, 6)]
    assert [(r.z, r.a1, r.c2, r.a3) for r in rows if r.z is not None] == [(0, 7, 8, 9)]


def test_headers_are_read_as_records(spark, roots, monkeypatch):
    folder = put(
        roots[0],
        "layouts",
        a='"x\ny",b\n1,2\n',
        b='"x\ny",b\r\n3,4\r\n',
        c='\n\ufeff"x""y",b\n5,6\n',
        d="b\n7\n",
        e="\n\n",
        f='6" pipe,b\n1,2\n3,4"\n',
    )
    with gzip.open(folder / "g.csv.gz", "wt") as file:
        file.write("b\n8\n")
    for size in (2**16, 3):
        monkeypatch.setattr("carebase.sources.raw.HEAD_BYTES", size)
        found = header_groups(spark, str(folder)).groups
        names = [[path.rsplit("/", 1)[1][0] for path in group] for group in found]
        assert sorted(names) == [["a", "b"], ["c"], ["d", "g"], ["f"]]
    split = header_groups(spark, str(folder), multi_line=False).groups
    assert len(split) == 4
    assert header_groups(spark, str(folder / "a.csv")).groups == [str(folder / "a.csv")]
    assert header_groups(spark, str(folder), header=False).groups == [str(folder)]
    assert header_groups(spark, str(folder / "e.csv")).groups == [str(folder / "e.csv")]


def test_equal_headers_stay_one_folder(spark, roots):
    folder = put(roots[0], OTHER, **{f"f{i}": f"k,v\n{i},x\n" for i in range(40)})
    assert header_groups(spark, str(folder)).groups == [str(folder)]


def test_folders_that_name_a_column_with_several_headers(spark, roots):
    put(roots[0], f"{OTHER}/year=1", a="k\n1\n")
    put(roots[0], f"{OTHER}/year=2", b="j,k\n2,3\n")
    run(spark, roots, OTHER)
    rows = refined(spark, roots, OTHER).collect()
    assert sorted((r.k, r.j or 0, int(r.year)) for r in rows) == [(1, 0, 1), (3, 2, 2)]


def test_appended_columns_are_those_stored(spark, roots):
    folder = put(roots[0], OTHER, a="k,v\n1,2\n")
    run(spark, roots, OTHER)
    (folder / "a.csv").write_text("k\n5\n")
    run(spark, roots, OTHER, mode="append")
    assert sorted((r.k, r.v or 0) for r in refined(spark, roots, OTHER).collect()) == [(1, 2), (5, 0)]
    (folder / "a.csv").write_text("k,v,w\n6,7,8\n")
    row = run(spark, roots, OTHER, mode="append", fail_on_error=False)[OTHER]
    assert row.status == "failed" and "w" in row.reason
    assert refined(spark, roots, OTHER).count() == 2


def test_shuffle_partitions_follow_the_input(spark):
    name = "spark.sql.shuffle.partitions"
    for size, expected in ((0, "8"), (5 * 2**30, "21"), (10**15, str(10**15 // 2**28 + 1))):
        with pytest.raises(KeyError), shuffle_partitions_for(spark, size):
            assert spark.conf.get(name) == expected
            raise KeyError
        assert spark.conf.get(name) == "8"


def test_a_large_source_is_shuffled_into_more_partitions(spark, roots, monkeypatch):
    put(roots[0], OTHER, a="k\n" + "".join(f"{i}\n" for i in range(1000)))
    monkeypatch.setattr("carebase.session.PARTITION_BYTES", 200)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        run(spark, roots, OTHER)
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert len(list((roots[1] / OTHER).glob("*.parquet"))) == 3890 // 200 + 1


@pytest.mark.parametrize("bad", [{"mode": "ignore"}, {"on_bad_value": "skip"}])
def test_options_are_checked(bad):
    with pytest.raises(ValueError):
        RefineOptions(**bad)


def test_other_errors_are_not_missing_sources(spark):
    assert not is_missing_source(ValueError("path does not exist"))
    with pytest.raises(PySparkException) as caught:
        spark.table("no_such_table")
    assert not is_missing_source(caught.value)


def test_cleaning_twice_changes_nothing(spark):
    df = spark.createDataFrame([(" na ", 1.0), ("x", float("nan")), ("x", float("nan"))], "a string, b double")
    once = drop_duplicates(standardize_missing(df))
    twice = drop_duplicates(standardize_missing(once))
    assert sorted(map(repr, once.collect())) == sorted(map(repr, twice.collect()))
    assert once.count() == 2


def test_lineage_columns_are_not_cleaned(spark):
    df = spark.createDataFrame([("na", "na")], "source_file string, v string")
    assert tuple(standardize_missing(df).first()) == ("na", None)


def test_duplicates_compare_nulls_nans_and_zeros(spark):
    nan = float("nan")
    rows = [(None, nan), (None, nan), ("a", 0.0), ("a", -0.0), ("a", None), ("a", None)]
    report = dedupe_report(spark.createDataFrame(rows, "a string, b double")).first()
    assert tuple(report) == (6, 3, 3)


def test_duplicates_by_some_columns(spark):
    df = spark.createDataFrame([(1, 1), (1, 2), (2, 1)], ["a", "b"])
    assert drop_duplicates(df, ["a"]).count() == 2


def test_dedupe_report_of_nothing(spark):
    assert tuple(dedupe_report(spark.createDataFrame([], "a string")).first()) == (0, 0, 0)


def test_equal_rows_are_combined_before_the_shuffle(spark):
    df = spark.range(9).selectExpr("'same' as a")
    plan = df.transform(drop_duplicates)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("HashAggregate") == 2


def test_register_refined(spark, roots):
    put(roots[0], OTHER, a="k\n1\n")
    run(spark, roots, OTHER)
    register_refined(spark, str(roots[1]), [OTHER])
    assert spark.sql(f"select k from {OTHER}").first().k == 1
