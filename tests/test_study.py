from __future__ import annotations

import duckdb
import pytest
from conftest import SMALL, rows

from indexday.operators.profile import funnel
from indexday.plans import study
from indexday.plans.presets import STROKE_STUDY
from indexday.sources import StageStore
from querybook.binding import VIEWS, bind, oracle_views
from querybook.params import STUDY


@pytest.fixture(scope="module")
def tables(spark):
    return bind(spark, SMALL)


@pytest.fixture(scope="module")
def stages(spark, tables):
    return study.run_study(STUDY, tables, StageStore(spark))


def test_binding_is_the_same_in_both_engines(tables):
    con = duckdb.connect()
    for t in ("customer", "nation", "supplier", "orders", "lineitem", "part", "events"):
        con.execute(f"create view {t} as select * from '{SMALL}/{t}.parquet'")
    for name in VIEWS:
        theirs = sorted(con.execute(oracle_views()[name]).fetchall(), key=str)
        assert sorted((tuple(r) for r in tables[name].collect()), key=str) == theirs, name


def test_stage_sizes(stages):
    # Sizes measured beforehand with plain SQL on the same tables.
    assert stages.events.count() == 471
    assert stages.cohort.count() == 36
    assert stages.outcome.count() == stages.features.count() == 35
    assert stages.coverage.count() == 35


def test_written_and_planned_stages_agree(tables, stages):
    """A written cohort is broadcast and a planned one shuffled; the rows must not differ."""
    planned = study.build_cohort(STUDY.cohort, tables)
    assert rows(planned) == rows(stages.cohort)
    assert rows(study.build_features(STUDY, tables, planned)) == rows(stages.features)
    assert rows(study.build_coverage(STUDY, tables, planned)) == rows(stages.coverage)


def test_attrition_equals_the_funnel_over_stages(tables, stages):
    steps = funnel(
        ("encounter", stages.events, "person_id"),
        ("observed", stages.cohort, "subject_id"),
        ("target", stages.outcome, "subject_id"),
    )
    direct = {r.name: (r.n_rows, r.n_persons) for r in study.attrition(STUDY.cohort, tables).collect()}
    for r in steps.collect():
        assert direct[r.name] == (r.n_rows, r.n_persons)


def test_the_preset_study_runs_on_any_claims_tables(spark, tables):
    """Its codes are not in the test tables, so every stage comes out empty with its columns."""
    out = study.run_study(STROKE_STUDY, tables, StageStore(spark))
    assert out.cohort.count() == out.features.count() == 0
    assert out.cohort.columns == [
        "subject_id", "condition_occurrence_id", "condition_concept_id", "cohort_start_date", "condition_end_date",
        "six_months_after_index", "visit_start_date", "visit_end_date", "discharge_to_concept_id",
        "discharge_location", "observation_period_start_date", "cohort_end_date", "observation_period_id",
        "has_aphasia", "has_dysphagia", "has_dysarthria", "cohort_definition_id",
    ]
    assert out.features.columns == [
        "subject_id", "slp_treatment_status", "has_parkinsons", "has_migraine", "has_depression", "has_insomnia",
        "has_dementia", "has_paralysis", "has_ischemic_stroke", "initial_ip_duration", "severity", "patient_age",
        "gender",
    ]
    assert out.coverage.columns == ["subject_id", "payer_source_value", "insurance_plan"]


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_no_pair_joins_and_one_scan_per_event_pass(tables, stages):
    features = plan(study.build_features(STUDY, tables, stages.cohort))
    cohort = plan(study.build_cohort(STUDY.cohort, tables, stages.events))
    for text in (features, cohort):
        assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text
    # Seven code groups share one pass over the conditions, and so do three flag sets; the
    # feature plan also scans line items for the procedures.
    assert features.count("lineitem.parquet") == 2
    assert cohort.count("lineitem.parquet") == 1


def test_filters_and_columns_reach_the_scan(spark, tables, tmp_path):
    tables["procedure_occurrence"].write.parquet(str(tmp_path / "p"))
    stored = spark.read.parquet(str(tmp_path / "p"))
    from indexday.operators.features import outcome_flag

    cohort = spark.createDataFrame([], "subject_id long, cohort_start_date date")
    text = plan(outcome_flag(cohort, stored, ["92507", "92508"], column="s", labels=("y", "n")))
    assert "In(procedure_source_value, [92507,92508])" in text
    assert "procedure_concept_id" not in text


def test_confirmation_prunes_days_ahead_of_the_exchange(stages):
    from indexday.operators.events import confirm_within

    text = plan(confirm_within(stages.events, "person_id", "condition_start_date", "condition_occurrence_id"))
    assert text.count("WindowGroupLimit") == 2
