"""The command line, from an inbox of CSVs to written views."""

import pytest

from carebase.datasets import CONTRACTOR_HOURS, EMPLOYEE_HOURS, HOURS
from carebase.jobs import main
from carebase.plans.refine import RefineError

CLAIMS_HEADER = (
    "CMS Certification Number (CCN),State,Measure Code,Measure Description,Resident Type,"
    "Measure Period,Adjusted Score,Processing Date\n"
)


def test_jobs(spark, tmp_path, capsys):
    inbox, refined, curated = (tmp_path / name for name in ("inbox", "refined", "curated"))
    inbox.mkdir()
    hours = [*HOURS, *EMPLOYEE_HOURS, *CONTRACTOR_HOURS]
    (inbox / "PBJ_Daily_Nurse_Staffing_Q2_2024.csv").write_text(
        ";".join(["PROVNUM", "STATE", "WorkDate", "MDScensus", *hours])
        + "\n"
        + ";".join(["015009", "AL", "20240401", "4", *["1"] * len(hours)])
        + "\n"
    )
    (inbox / "NH_QualityMsr_Claims_Oct2024.csv").write_text(CLAIMS_HEADER.replace(",", ";"))
    main(
        ["ingest", "--inbox", str(inbox), "--state", str(tmp_path / "state")]
        + ["--refined", str(refined), "--delimiter", ";"],
        spark,
    )
    main(["views", "--refined", str(refined), "--curated", str(curated)], spark)
    load = spark.read.parquet(str(curated / "staffing_vs_patient_load")).collect()
    assert [tuple(row) for row in load] == [("015009", "AL", 4.0, 8.0, 2.0)]
    assert "lowest_staffing_vs_patient_load" in capsys.readouterr().out


def test_refine_job_fails_at_the_end(spark, tmp_path, capsys):
    raw, refined = tmp_path / "raw", tmp_path / "refined"
    for name, text in (("pbj_daily_nurse_staffing", "MDScensus\nx\n"), ("nh_penalties", "k\n1\n")):
        (raw / name).mkdir(parents=True)
        (raw / name / "a.csv").write_text(text)
    arguments = ["refine", "--raw", str(raw), "--refined", str(refined)]
    arguments += ["--datasets", "pbj_daily_nurse_staffing, nh_penalties"]
    with pytest.raises(RefineError):
        main(arguments, spark)
    assert spark.read.parquet(str(refined / "nh_penalties")).count() == 1
    main([*arguments, "--keep-going"], spark)
    assert "failed" in capsys.readouterr().out


def test_unknown_write_mode_is_refused(capsys):
    with pytest.raises(SystemExit):
        main(["views", "--refined", "a", "--curated", "b", "--write-mode", "ignore"])
