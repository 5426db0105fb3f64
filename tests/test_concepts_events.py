from __future__ import annotations

import pytest
from conftest import day, rows
from pyspark.sql import functions as F

from indexday.operators import concepts as cc
from indexday.operators import events as ev
from indexday.operators import sizing
from indexday.spec import CodeGroup, CodeSet

P, D, E = "person_id", "event_date", "event_id"
EVENTS = "event_id long, person_id long, event_date date"


@pytest.fixture
def vocabulary(frame):
    return frame(
        [(1, "G20"), (2, "G20.1"), (3, "G200"), (4, "F05.1"), (5, "I63.9"), (6, "G43"), (7, None)],
        "concept_id long, concept_code string",
    )


def test_expansion(frame, vocabulary):
    # 10 has no row for itself, 99 is not a concept, 10 and 20 share concept 2.
    below = frame([(10, 1), (10, 2), (10, 99), (20, 2), (20, 20), (30, 3)], "ancestor_concept_id int, descendant_concept_id int")
    assert rows(cc.expand_concepts(below, vocabulary, (10, 20))) == [(1,), (2,)]
    assert rows(cc.expand_concepts(below, vocabulary, (77,))) == []


def test_code_map_has_one_row_per_concept(vocabulary):
    groups = [CodeGroup("park", ("G20",)), CodeGroup("neuro", ("G20", "G43"), ("F05.1",))]
    assert rows(cc.code_map(vocabulary, groups)) == [(1, 1, 1), (2, 1, 1), (4, 0, 1), (6, 0, 1)]


def test_code_map_with_a_vocabulary(frame):
    concept = frame([(1, "G20", "A"), (2, "G20", "B")], "concept_id long, concept_code string, vocabulary_id string")
    assert rows(cc.code_map(concept, [CodeGroup("g", ("G20",), vocabulary="B")])) == [(2, 1)]


def test_tags_for_codes_in_two_sets(frame):
    df = frame([(1, 5), (2, 6), (3, 7)], "event_id long, code int")
    out = cc.tag_by_ids(df, "code", [CodeSet("a", (5, 6)), CodeSet("b", (6,))])
    assert rows(out) == [(1, 5, 1, 0), (2, 6, 1, 1)]


def test_broadcast_only_after_a_size_check(spark, frame):
    df = spark.range(1000).withColumn("t", F.lit("x" * 10))
    # Eight bytes for each fixed part, ten for the text.
    assert sizing.measured_bytes(df, 100_000) == 1000 * (8 + 8 + 10)
    assert sizing.measured_bytes(df, 5_000) is None
    assert sizing.broadcast_if_small(df, limit=10) is df
    assert "broadcast" in sizing.broadcast_if_small(df, limit=100_000)._jdf.queryExecution().logical().toString().lower()


def test_same_rows_without_the_broadcast(frame, monkeypatch):
    df = frame([(1, 5), (2, 6)], "event_id long, code long")
    ids = frame([(5,)], "concept_id long")
    small = rows(cc.in_concepts(df, "code", ids))
    monkeypatch.setattr(cc, "broadcast_if_small", lambda d: d)
    assert rows(cc.in_concepts(df, "code", ids)) == small == [(5, 1)]


def test_qualifying_events(frame):
    conditions = frame(
        [(1, 1, 10, day(0), day(1), 100), (2, 1, 11, day(0), day(1), 100), (3, 2, 10, day(0), day(1), 101),
         (4, 2, 10, day(0), day(1), None)],
        "condition_occurrence_id long, person_id long, condition_concept_id int, condition_start_date date, "
        "condition_end_date date, visit_occurrence_id long",
    )
    visits = frame(
        [(100, 7, day(-1), day(2), 0), (101, 8, day(-1), day(2), 0)],
        "visit_occurrence_id long, visit_concept_id int, visit_start_date date, visit_end_date date, "
        "discharge_to_concept_id int",
    )
    ids = "concept_id long"
    out = ev.qualifying_events(conditions, visits, frame([(10,)], ids), frame([(7,)], ids))
    assert rows(out.select("condition_occurrence_id")) == [(1,)]


def test_index_event_breaks_ties_by_id(frame):
    df = frame([(5, 1, day(0)), (4, 1, day(0)), (1, 1, day(3)), (9, 2, None), (8, 3, day(1)), (7, 3, None)], EVENTS)
    assert rows(ev.index_event(df, P, D, E)) == [(4, 1, day(0)), (8, 3, day(1))]


def test_day_ranks(frame):
    df = frame([(1, 1, day(0)), (2, 1, day(0)), (3, 1, day(5)), (4, 2, day(9))], EVENTS)
    assert rows(ev.rank_days(df, P, D).select(E, "day_rank")) == [(1, 1), (2, 1), (3, 2), (4, 1)]


def test_confirmation_needs_a_second_day_in_time(frame):
    df = frame(
        [(1, 1, day(0)), (2, 1, day(180)), (3, 2, day(0)), (4, 2, day(181)), (5, 3, day(0)), (6, 3, day(0)),
         (7, 4, day(0)), (8, 4, None), (9, 5, day(0)), (10, 5, day(3)), (11, 5, day(400))],
        EVENTS,
    )
    out = ev.confirm_within(df, P, D, E, 180)
    assert rows(out) == [(1, 1, day(0), day(180)), (9, 5, day(0), day(3))]


def test_event_counts_survive_the_fold(frame):
    df = frame([(i, 1, day(i % 3)) for i in range(50)], EVENTS)
    assert rows(ev.index_with_confirmation(df, P, D, E, count="n")) == [(0, 1, day(0), day(1), 50)]


def test_observation_bounds(frame):
    index = frame([(i, day(0)) for i in range(1, 6)], "person_id long, event_date date")
    periods = frame(
        [(1, 11, day(-180), day(180)), (2, 12, day(-179), day(400)), (3, 13, day(-400), day(179)),
         (4, 14, day(-400), day(-1)), (4, 15, day(-300), day(300)), (5, 16, day(-900), day(-500))],
        "person_id long, observation_period_id long, observation_period_start_date date, observation_period_end_date date",
    )
    out = ev.require_observation(index, periods, person=P, date=D)
    assert rows(out.select(P, "observation_period_id")) == [(1, 11), (4, 15)]


def test_two_periods_give_two_rows(frame):
    index = frame([(1, day(0))], "person_id long, event_date date")
    periods = frame(
        [(1, 1, day(-200), day(200)), (1, 2, day(-300), day(300))],
        "person_id long, observation_period_id long, observation_period_start_date date, observation_period_end_date date",
    )
    assert ev.require_observation(index, periods, person=P, date=D).count() == 2


def test_first_day_events_keep_ties(frame):
    df = frame([(1, 1, day(0)), (2, 1, day(0)), (3, 1, day(1)), (4, 2, day(7))], EVENTS)
    assert rows(ev.first_day_events(df, P, D).select(E)) == [(1,), (2,), (4,)]
