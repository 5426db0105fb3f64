from __future__ import annotations

import pytest
from conftest import day, rows

from indexday.operators import features as ft
from indexday.operators.profile import after_index
from indexday.spec import CategoryRule, CodeGroup, CodeSet

COHORT = "subject_id long, cohort_start_date date, visit_end_date date"
CONDITIONS = "person_id long, condition_concept_id int, condition_start_date date"
SETS = [CodeSet("a", (1,)), CodeSet("b", (1, 2))]


@pytest.fixture(params=["planned", "written"])
def cohort(request, spark, frame, tmp_path):
    """Five subjects; written out the cohort has a known size and is broadcast."""

    def make(n=5):
        df = frame([(i, day(0), day(7)) for i in range(1, n + 1)], COHORT)
        if request.param == "planned":
            return df
        path = str(tmp_path / f"cohort-{n}")
        df.write.mode("ignore").parquet(path)
        return spark.read.parquet(path)

    return make


def test_the_two_cohort_forms_differ_in_plan(cohort, request):
    small = ft.known_small(cohort())
    assert (small is None) == ("planned" in request.node.name)


def test_condition_flags(cohort, frame):
    events = frame(
        [(1, 1, day(-9)), (1, 1, day(-3)),  # both before
         (2, 1, day(-9)), (2, 1, day(0)),  # one before, one on the index date
         (3, 1, day(4)),  # one day only
         (4, 2, day(4)), (4, 2, day(4)),  # one day twice
         (5, 2, day(1)), (5, 1, day(2))],  # two codes of one set
        CONDITIONS,
    )
    out = ft.condition_flags(cohort(), events, SETS).select("subject_id", "a", "b")
    assert rows(out) == [(1, 0, 0), (2, 1, 1), (3, 0, 0), (4, 0, 0), (5, 0, 1)]
    strict = ft.condition_flags(cohort(), events, SETS, strict=True).select("subject_id", "a", "b")
    assert rows(strict) == [(1, 0, 0), (2, 0, 0), (3, 0, 0), (4, 0, 0), (5, 0, 1)]


def test_outcome(cohort, frame):
    procedures = frame(
        [(1, "92507", day(0)), (2, "92507", day(-1)), (3, "G0151", day(3)), (4, "92507", day(-4)), (4, "92508", day(9))],
        "person_id long, procedure_source_value string, procedure_date date",
    )
    out = ft.outcome_flag(cohort(), procedures, ["92507", "92508"], column="status", labels=("yes", "no"))
    assert rows(out.select("subject_id", "status")) == [(1, "yes"), (2, "no"), (3, "no"), (4, "yes"), (5, "no")]


def test_window_flags(cohort, frame):
    groups = [CodeGroup("wide"), CodeGroup("ahead", before=0)]
    mapping = frame([(1, 1, 0), (2, 0, 1), (3, 1, 1)], "concept_id long, wide int, ahead int")
    events = frame(
        [(1, 1, day(-181)), (1, 1, day(31)), (1, 2, day(-1)),  # all just outside
         (2, 1, day(-180)), (2, 2, day(30)),  # just inside
         (3, 3, day(-1)),  # inside one window only
         (4, 3, day(0)), (4, 9, day(0))],
        "person_id long, condition_source_concept_id long, condition_start_date date",
    )
    out = ft.window_flags(cohort(), events, mapping, groups)
    assert out.columns == ["subject_id", "cohort_start_date", "visit_end_date", "wide", "ahead"]
    got = rows(out.select("subject_id", "wide", "ahead"))
    assert got == [(1, 0, 0), (2, 1, 1), (3, 1, 0), (4, 1, 1), (5, 0, 0)]


def test_stay(frame):
    df = frame([(1, day(0), day(7)), (2, day(0), day(8)), (3, day(0), None), (4, day(0), day(-2))], COHORT)
    out = ft.stay_severity(df, labels=("mild", "severe")).select("subject_id", "initial_ip_duration", "severity")
    assert rows(out) == [(1, 7, "mild"), (2, 8, "severe"), (3, None, None), (4, -2, "mild")]


def test_demographics(cohort, frame):
    person = frame([(1, 1937, "F"), (2, 2003, None)], "person_id long, year_of_birth int, gender_source_value string")
    out = ft.demographics(cohort(3), person).select("subject_id", "patient_age", "gender")
    assert rows(out) == [(1, 83, "F"), (2, 17, None), (3, None, None)]


def test_coverage_keeps_overlaps_and_drops_the_uncovered(cohort, frame):
    rules = [CategoryRule("P", (1,)), CategoryRule("Q", (2,), ("v",))]
    plans = frame(
        [(1, 1, "v", day(-9), day(0)), (1, 2, "w", day(0), day(5)), (2, 3, "v", day(-1), day(1)),
         (3, 1, "v", day(1), day(9)), (4, 7, "z", day(-9), day(9)), (5, 1, "v", day(-9), day(-1))],
        "person_id long, payer_concept_id int, payer_source_value string, payer_plan_period_start_date date, "
        "payer_plan_period_end_date date",
    )
    out = ft.coverage_at_index(cohort(), plans, rules)
    assert rows(out) == [(1, "v", "P"), (1, "w", "Q"), (2, "v", "Q"), (4, "z", None)]


def test_score_counts_a_group_once_up_to_the_index(cohort, frame):
    weights = frame([(1, "g", 1), (2, "g", 3), (3, "h", 2)], "concept_id long, score_group string, weight int")
    events = frame(
        [(1, 1, day(-5)), (1, 2, day(0)), (1, 3, day(1)), (2, 1, day(-1)), (2, 3, day(-1)), (2, 3, day(-9)),
         (3, 2, day(4)), (4, 8, day(-1))],
        CONDITIONS,
    )
    scores = ft.comorbidity_score(cohort(), events, weights)
    assert rows(scores) == [(1, 3.0), (2, 3.0)]
    assert rows(ft.as_covariates(scores, 1901)) == [(1, 1901, 3.0), (2, 1901, 3.0)]


def test_weight_map(spark):
    assert rows(ft.weight_map(spark, {5: ("g", 2)})) == [(5, "g", 2)]


def test_events_in_window(cohort, frame):
    days = (-181, -180, -1, 0, 30, 31)
    events = frame([(1, day(d), d) for d in days] + [(9, day(0), 0), (2, None, 7)], "person_id long, d date, off int")

    def offsets(before, after):
        near = ft.events_in_window(cohort(), events, person="person_id", date="d", before=before, after=after)
        return sorted(r.off for r in near.collect())

    assert offsets(180, 30) == [-180, -1, 0, 30]
    assert offsets(0, None) == [0, 30, 31]
    assert offsets(None, -1) == [-181, -180, -1]


def test_events_after_index(cohort, frame):
    events = frame([(1, day(0), 7), (1, day(0), 7), (1, day(2), 8), (2, day(-1), 7), (9, day(5), 7)],
                   "person_id long, d date, provider_id long")
    assert rows(after_index(cohort(), events, person="person_id", date="d")) == [(1, 3)]
    assert rows(after_index(cohort(), events, person="person_id", date="d", by=["provider_id"])) == [(1, 7, 2), (1, 8, 1)]


def test_one_heavy_person(spark, cohort):
    """A person with a third of all events comes out right in both join forms."""
    events = spark.sql(
        """select cast(if(id % 3 = 0, 1, 2 + id % 40) as long) as person_id,
                  cast(1 + id % 2 as long) as condition_source_concept_id,
                  date_add(date '2019-10-01', cast(id % 500 as int)) as condition_start_date
           from range(30000)"""
    )
    mapping = spark.createDataFrame([(1, 1), (2, 0)], "concept_id long, g int")
    group = CodeGroup("g")
    out = ft.window_flags(cohort(), events, mapping, [group]).select("subject_id", "g")
    brute = {
        s: int(any(e.person_id == s and e.condition_source_concept_id == 1 and day(-180) <= e.condition_start_date <= day(30)
                   for e in events.collect()))
        for s in range(1, 6)
    }
    assert dict(rows(out)) == brute


def test_rows_of_a_subject_all_stay(spark, frame, tmp_path):
    """Equal cohort rows and rows of two periods keep their number, planned or written."""
    data = [(1, day(0), day(7), 10), (1, day(0), day(7), 10), (1, day(0), day(7), 11), (2, day(0), day(9), 20)]
    planned = frame(data, COHORT + ", observation_period_id int")
    planned.write.parquet(str(tmp_path / "cohort"))
    written = spark.read.parquet(str(tmp_path / "cohort"))
    events = frame([(1, 1, day(-3)), (1, 1, day(2)), (1, 1, day(2)), (2, 2, day(1))], CONDITIONS)
    procedures = frame([(1, "x", day(1))], "person_id long, procedure_source_value string, procedure_date date")
    mapping = frame([(1, 1)], "concept_id int, g int")
    steps = {
        "condition": lambda c: ft.condition_flags(c, events, SETS),
        "outcome": lambda c: ft.outcome_flag(c, procedures, ["x"], column="status", labels=("yes", "no")),
        "window": lambda c: ft.window_flags(c, events, mapping, [CodeGroup("g")], code="condition_concept_id"),
    }
    for name, step in steps.items():
        small, large = rows(step(written)), rows(step(planned))
        assert small == large and len(small) == len(data), name
        assert [r[:4] for r in small] == sorted(tuple(r) for r in data), name
