"""Study parameters that fit the test tables."""

from __future__ import annotations

from indexday.spec import CategoryRule, CodeGroup, CodeSet, CohortSpec, ModelSpec, StudySpec
from indexday.plans.presets import PROCEDURE_CODES

COHORT = CohortSpec(
    encounter_ancestors=(300,),
    event_ancestors=(100,),
    flag_sets=(CodeSet("has_a", (1, 6)), CodeSet("has_b", (2, 7, 12)), CodeSet("has_c", (3,))),
    destinations=(
        CategoryRule("Home", (400, 401)),
        CategoryRule("Rehab", (402,)),
        CategoryRule("SNF/LTC", (403,)),
        CategoryRule("Acute", (404,)),
        CategoryRule("Other", (405,)),
    ),
)

MODEL = ModelSpec(
    procedure_codes=PROCEDURE_CODES,
    outcome_column="treatment_status",
    outcome_labels=("treated", "untreated"),
    code_groups=(
        CodeGroup("has_park", ("S10", "S11", "S12")),
        CodeGroup("has_migr", ("E20", "E21")),
        CodeGroup("has_depr", ("M30", "M31")),
        CodeGroup("has_inso", ("P05", "L05")),
        CodeGroup("has_deme", ("E01", "E02", "E03", "M10", "M11"), ("P07.1",)),
        CodeGroup("has_para", ("S20", "S21", "S22"), before=0),
        CodeGroup("has_isch", ("S30",), before=0),
    ),
    severity_days=7,
    severity_labels=("mild", "severe"),
    coverage_rules=(
        CategoryRule("P1", (501,)),
        CategoryRule("P2", (502, 503)),
        CategoryRule("P3", (504,), ("B|BUILDING",)),
        CategoryRule("P4", (505,)),
    ),
)

STUDY = StudySpec(COHORT, MODEL)

SERVICE_CONCEPTS = (1, 2, 3)
PROFILED_PERSON = 8
RELABEL_HOME = ("No matching concept", "Discharged to Home")

LABELS = {
    "has_park": "Parkinson's Disease",
    "has_migr": "Migraine",
    "has_depr": "Depression",
    "has_inso": "Insomnia",
    "has_deme": "Dementia",
    "has_para": "Paralysis",
    "has_isch": "Ischemic Stroke",
    "severity": "Severity",
    "gender": "Gender",
    "age_group": "Age Group",
    "patient_age": "Age *",
    "cci": "Comorbidity Index",
    "insurance_plan": "Insurance Plan",
    "treatment_status": "Treatment Status",
}

CATEGORICAL = (*MODEL.features, "severity", "gender", "age_group", "insurance_plan", "treatment_status")
CONTINUOUS = ("patient_age", "cci")
STRATA = ("subject_id", *CATEGORICAL, *CONTINUOUS)
PREDICTORS = (*MODEL.features, "severity", "gender", "age_group")
