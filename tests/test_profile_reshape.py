from __future__ import annotations

from conftest import day, rows

from indexday.operators import profile as pr
from indexday.operators import reshape as rs


def test_pivot_fills_empty_cells_and_drops_null_keys(frame):
    df = frame([(1, 0), (1, 0), (2, 1), (None, 1), (3, None), (2, 7)], "y int, f int")
    out = rs.pivot_counts(df, "y", "f", [0, 1], ["no", "yes"])
    assert rows(out) == [(1, 2, 0), (2, 0, 1)]


def test_sorted_by_total(frame):
    df = frame([("a", 1, 1), ("b", 5, 0), ("c", 0, 2)], "k string, x int, y int")
    assert [r.k for r in rs.sort_by_row_total(df, ["x", "y"], "k").collect()] == ["b", "a", "c"]
    assert rs.sort_by_row_total(df, ["x", "y"], "k").columns == ["k", "x", "y"]


def test_append_with_different_columns(frame):
    out = rs.append(frame([(1, "x")], "a int, b string"), frame([(2, 5.0)], "a int, c double"))
    assert rows(out) == [(1, "x", None), (2, None, 5.0)]


def test_total_counts_a_person_once(frame):
    df = frame([("a", 1, "m"), ("b", 1, "m"), ("b", 2, None)], "g string, id int, s string")
    out = rs.with_total(df, "g", ["id", "s"])
    assert rows(out.filter("g = 'Total'").select("id", "s")) == [(1, "m"), (2, None)]


def test_long_form(frame):
    out = rs.to_long(frame([(1, 0, 1)], "id int, a int, b int"), ["id"], ["a", "b"], "name", "value")
    assert rows(out) == [(1, "a", 0), (1, "b", 1)]
    assert rs.as_text(frame([(1, 2)], "a int, b int"), ["b"]).dtypes == [("a", "int"), ("b", "string")]


def test_overlaps(frame):
    # Ids repeat, one id is in all sets, c has nobody on its own.
    df = frame([(1, 1, 0, 0), (1, 1, 0, 0), (2, 1, 1, 1), (3, 0, 1, None), (4, 0, 0, 0)], "id int, a int, b int, c int")
    flags = ["a", "b", "c"]
    assert dict(rows(rs.set_sizes(df, flags))) == {"a": 3, "b": 2, "c": 1}
    counts = dict(rows(rs.overlap_counts(df, "id", flags)))
    assert counts == {"a": 2, "b": 2, "c": 1, "a & b": 1, "a & c": 1, "b & c": 1, "a & b & c": 1}
    regions = dict(rows(rs.overlap_regions(df, "id", flags)))
    assert regions == {
        "a only": 1, "b only": 1, "c only": 0, "a & b only": 0, "a & c only": 0, "b & c only": 0, "a & b & c only": 1,
    }


def test_empty_set_has_no_overlap(frame):
    out = rs.overlap_counts(frame([(1, 1, 0)], "id int, a int, b int"), "id", ["a", "b"])
    assert dict(rows(out)) == {"a": 1, "b": 0, "a & b": 0}


def test_top_k_breaks_ties_by_key(frame):
    df = frame([(3,), (3,), (1,), (1,), (2,)], "person_id int")
    assert [tuple(r) for r in pr.top_k(df, "person_id", 2).collect()] == [(1, 2), (3, 2)]


def test_persons_below(frame):
    df = frame([(1,)] * 3 + [(2,)] * 2 + [(3,)], "person_id int")
    assert pr.persons_below(df, "person_id", 3).first().n_persons == 2
    assert pr.distinct_persons(df).first().n_persons == 3


def test_profile_of_a_person(frame):
    events = frame([(1, 5), (1, 5), (1, 9), (2, 5)], "person_id int, code int")
    concept = frame([(5, "five")], "concept_id long, concept_name string")
    assert rows(pr.code_profile(events, 1, "code", concept)) == [(5, 2, "five")]
    assert rows(pr.code_profile(events, 1, "code", concept, how="left")) == [(5, 2, "five"), (9, 1, None)]


def test_service_split(frame):
    cohort = frame([(1, day(0), 1), (2, day(0), 0), (3, day(0), None)], "subject_id int, cohort_start_date date, f int")
    services = frame([(1, day(-1)), (1, day(0)), (2, day(-1))], "person_id int, procedure_date date")
    split = pr.service_split(pr.service_status(cohort, services, "f"), "f")
    assert split.first().asDict() == {
        "count_null": 2, "count_not_null": 1, "count_null_f_1": 0, "count_not_null_f_1": 1,
        "count_null_f_0": 1, "count_not_null_f_0": 0,
    }
    tidy = pr.service_split_long(split, "f", ("none", "some"))
    assert rows(tidy) == [("none", 0, 1), ("none", 1, 0), ("some", 0, 0), ("some", 1, 1)]


def test_specialty_counts_skip_visits_without_provider(frame):
    cohort = frame([(1, day(0))], "subject_id long, cohort_start_date date")
    visits = frame(
        [(1, day(0), 7), (1, day(3), 8), (1, day(3), 9), (1, day(-1), 7), (1, day(1), None), (2, day(1), 7)],
        "person_id long, visit_start_date date, provider_id long",
    )
    provider = frame([(7, "A"), (8, None), (9, None)], "provider_id long, specialty_source_value string")
    out = pr.utilisation_by_specialty(cohort, visits, provider)
    assert [tuple(r) for r in out.collect()] == [("No Specialty", 2), ("A", 1)]
    assert pr.utilisation_by_specialty(cohort, visits, provider, k=1).count() == 1


def test_discharge_counts(frame):
    cohort = frame([(11,), (12,), (13,)], "condition_occurrence_id long")
    events = frame([(11, 1), (12, 2), (13, 3), (14, 1)], "condition_occurrence_id long, visit_occurrence_id long")
    visits = frame([(1, 0), (2, 0), (3, 5)], "visit_occurrence_id long, discharge_to_concept_id int")
    concept = frame([(0, "none"), (5, "Rehab")], "concept_id long, concept_name string")
    out = pr.discharge_counts(cohort, events, visits, concept, ("none", "Home"))
    assert [tuple(r) for r in out.collect()] == [(0, 2, "Home"), (5, 1, "Rehab")]


def test_funnel_over_stages(frame):
    a, b = frame([(1,), (1,), (2,)], "p int"), frame([(1,)], "q int")
    assert rows(pr.funnel(("all", a, "p"), ("left", b, "q"))) == [(1, "all", 3, 2), (2, "left", 1, 1)]
