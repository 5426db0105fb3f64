"""The reference study's parameters: speech and swallowing therapy after a stroke."""

from __future__ import annotations

from indexday.spec import CategoryRule, CodeGroup, CodeSet, CohortSpec, ModelSpec, StudySpec

# Concept ids, code lists and labels a study must use to get the same results.

INPATIENT_ANCESTORS = (9201, 9203, 262)
STROKE_ANCESTORS = (372924, 375557, 376713, 443454, 441874, 439847, 432923)

APHASIA = (440424, 40480002)
DYSPHAGIA = (31317, 440530, 26823, 443465, 45757559, 4198185)
DYSARTHRIA = (4196636, 43530687)

PROCEDURE_CODES = (
    "92507", "92508", "92520", "92521", "92522", "92523", "92524", "92526", "92597", "92605",
    "92606", "92607", "92608", "92609", "92610", "92611", "92612", "92613", "92614", "92615",
    "92616", "92617", "96105", "97129", "97130",
)
SERVICE_CONCEPTS = (44816446, 2313701, 2314188)

STROKE_COHORT = CohortSpec(
    encounter_ancestors=INPATIENT_ANCESTORS,
    event_ancestors=STROKE_ANCESTORS,
    flag_sets=(
        CodeSet("has_aphasia", APHASIA),
        CodeSet("has_dysphagia", DYSPHAGIA),
        CodeSet("has_dysarthria", DYSARTHRIA),
    ),
    destinations=(
        CategoryRule("Home", (581476, 0, 38004519, 9202)),
        CategoryRule("Inpatient Rehabilitation Facility", (38004285, 8920)),
        CategoryRule("SNF/LTC", (8863, 38004277, 8676)),
        CategoryRule("Acute Care", (8717, 32254, 32276)),
        CategoryRule("Other", (8546, 8951, 38004284, 38003619)),
    ),
)

STROKE_MODEL = ModelSpec(
    procedure_codes=PROCEDURE_CODES,
    outcome_column="slp_treatment_status",
    outcome_labels=("SLP_treatment", "without_SLP_treatment"),
    code_groups=(
        CodeGroup("has_parkinsons", ("G20", "G21", "G22")),
        CodeGroup("has_migraine", ("G43", "G44")),
        CodeGroup("has_depression", ("F32", "F33")),
        CodeGroup("has_insomnia", ("G47", "F51")),
        CodeGroup("has_dementia", ("F00", "F01", "F02", "F03", "G30", "G31", "R54"), ("F05.1",)),
        CodeGroup("has_paralysis", ("G81", "G82", "G83"), before=0),
        CodeGroup("has_ischemic_stroke", ("I63",), before=0),
    ),
    severity_days=7,
    severity_labels=("mild stroke", "severe stroke"),
    coverage_rules=(
        CategoryRule("Medicare Gap", (420,)),
        CategoryRule("Medicare Advantage", (282, 283, 280)),
        CategoryRule(
            "Commercial PPO/HMO", (330, 329, 331), ("Self-Insured|Preferred Provider Organization",)
        ),
        CategoryRule("Commercial HDHP", values=("Commercial|Consumer Directed Health Care",)),
        CategoryRule("Medicaid", (291, 289)),
        CategoryRule(
            "Missing",
            values=(
                "Unknown/Missing|Unknown/Missing",
                "Commercial|Unknown/Missing",
                "Unknown/Missing|Health Maintenance Organization",
            ),
        ),
    ),
)

STROKE_STUDY = StudySpec(STROKE_COHORT, STROKE_MODEL)

STROKE_LABELS = {
    "has_parkinsons": "Parkinson's Disease",
    "has_migraine": "Migraine",
    "has_depression": "Depression",
    "has_insomnia": "Insomnia",
    "has_dementia": "Dementia",
    "has_paralysis": "Paralysis",
    "has_ischemic_stroke": "Ischemic Stroke",
    "severity": "Severity",
    "gender": "Gender",
    "age_group": "Age Group",
    "patient_age": "Age *",
    "cci": "Charlson Comorbidity Index",
    "insurance_plan": "Insurance Plan",
    "slp_treatment_status": "SLP Treatment Status",
}
