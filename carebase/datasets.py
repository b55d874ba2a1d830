"""Names, patterns and types that the rest of the package is driven by."""

from __future__ import annotations

from collections.abc import Iterable

# --- Fixed values -----------------------------------------------------------
# Results depend on these exact texts. Order matters for the routes: the first
# match wins. The keys are also the list of known datasets.
ROUTES = {
    "snf_vbp_aggregate": r"^FY_\d{4}_SNF_VBP_Aggregate_Performance\.csv$",
    "snf_vbp_facility": r"^FY_\d{4}_SNF_VBP_Facility_Performance\.csv$",
    "nh_citation_descriptions": r"^NH_CitationDescriptions_.*\.csv$",
    "nh_covid_vax_averages": r"^NH_CovidVaxAverages_.*\.csv$",
    "nh_covid_vax_provider": r"^NH_CovidVaxProvider_.*\.csv$",
    "nh_data_collection_intervals": r"^NH_DataCollectionIntervals_.*\.csv$",
    "nh_fire_safety_citations": r"^NH_FireSafetyCitations_.*\.csv$",
    "nh_health_citations": r"^NH_HealthCitations_.*\.csv$",
    "nh_health_inspection_cutpoints_state": r"^NH_HlthInspecCutpointsState_.*\.csv$",
    "nh_ownership": r"^NH_Ownership_.*\.csv$",
    "nh_penalties": r"^NH_Penalties_.*\.csv$",
    "nh_provider_info": r"^NH_ProviderInfo_.*\.csv$",
    "nh_quality_measure_claims": r"^NH_QualityMsr_Claims_.*\.csv$",
    "nh_quality_measure_mds": r"^NH_QualityMsr_MDS_.*\.csv$",
    "nh_state_us_averages": r"^NH_StateUSAverages_.*\.csv$",
    "nh_survey_dates": r"^NH_SurveyDates_.*\.csv$",
    "nh_survey_summary": r"^NH_SurveySummary_.*\.csv$",
    "pbj_daily_nurse_staffing": r"^PBJ_Daily_Nurse_Staffing_.*\.csv$",
    "snf_qrp_national": r"^Skilled_Nursing_Facility_Quality_Reporting_Program_National_Data_.*\.csv$",
    "snf_qrp_provider": r"^Skilled_Nursing_Facility_Quality_Reporting_Program_Provider_Data_.*\.csv$",
    "swing_bed_snf": r"^Swing_Bed_SNF_data_.*\.csv$",
}
UNMAPPED = "_unmapped"

MISSING_TOKENS = ("", "na", "n/a", "null", "none", ".", "nan")

HOUR_ROLES = ("rndon", "rnadmin", "rn", "lpnadmin", "lpn", "cna", "natrn", "medaide")

READMISSION_MEASURES = (521, 551)
# ----------------------------------------------------------------------------

DATASETS = tuple(ROUTES)
STAFFING = "pbj_daily_nurse_staffing"
CLAIMS = "nh_quality_measure_claims"

HOURS = tuple(f"hrs_{role}" for role in HOUR_ROLES)
EMPLOYEE_HOURS = tuple(f"{hours}_emp" for hours in HOURS)
CONTRACTOR_HOURS = tuple(f"{hours}_ctr" for hours in HOURS)

# Facility ids keep leading zeros and letters, whatever inference would make of them.
ID_COLUMNS = ("provnum", "cms_certification_number_ccn")

# Types of the columns the curated queries read; other columns of these two
# datasets stay text. Datasets that are not listed here are inferred.
DECLARED_TYPES = {
    STAFFING: {
        "workdate": "int",
        "mdscensus": "double",
        **{name: "double" for name in HOURS + EMPLOYEE_HOURS + CONTRACTOR_HOURS},
    },
    CLAIMS: {"measure_code": "int", "processing_date": "date"},
}


def pick_datasets(names: str | Iterable[str] | None = None) -> list[str]:
    """Known datasets, or the ones of a comma list / iterable, freed of blanks and slashes."""
    if isinstance(names, str):
        names = names.split(",")
    picked = [name.strip().strip("/") for name in names or () if name.strip()]
    return picked or list(DATASETS)


def dataset_path(root: str, dataset: str) -> str:
    return f"{root.rstrip('/')}/{dataset}"
