"""Persons with very many rows: interval index, sweep, first days, bitmaps, selection."""

from __future__ import annotations

import random

import numpy as np
import pytest
from conftest import day, rows
from pyspark.sql import functions as F

from indexday.operators import bitmaps
from indexday.operators import events as ev
from indexday.operators import features as ft
from indexday.operators import reshape as rs
from indexday.operators.intervals import points_in_intervals
from indexday.operators.selection import order_statistics
from indexday.operators.sweep import flags_around_dates
from indexday.sources import StageStore
from indexday.spec import CodeGroup


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_points_meet_their_intervals(frame):
    rnd = random.Random(6)
    lengths = [0, 1, 3, 63, 64, 65, 255, 256, 300, 1024, 4000, 4097, 20_000, 400_000]
    spans = []
    for i in range(400):
        start = rnd.randint(-9000, 9000)
        spans.append((rnd.randint(1, 4), day(start), day(start + rnd.choice(lengths) - 1), i))
    spans += [(1, None, day(0), 900), (1, day(0), None, 901), (None, day(-9), day(9), 902), (2, day(-9), day(9), 903), (2, day(-9), day(9), 903)]
    points = [(rnd.randint(1, 5), day(rnd.randint(-9500, 9500)), i) for i in range(300)] + [(1, None, 900), (None, day(0), 901), (2, day(0), 902)] * 2
    left = frame(points, "k int, d date, id int")
    right = frame(spans, "k int, a date, b date, span int")
    got = rows(points_in_intervals(left, right, key="k", point="d", start="a", end="b", keep=["span"]).select("id", "span"))
    want = [
        (p[2], s[3]) for p in points for s in spans
        if None not in (p[0], p[1], *s[:3]) and p[0] == s[0] and s[1] <= p[1] <= s[2]
    ]
    assert got == sorted(want, key=lambda t: tuple((v is None, str(v)) for v in t)) and len(got) > 500
    with pytest.raises(ValueError, match="both sides"):
        points_in_intervals(left, right, key="k", point="d", start="a", end="b", keep=["k"])


def test_a_person_with_ten_thousand_periods(spark, frame):
    periods = spark.range(10_000).select(
        F.lit(1).alias("person_id"), F.col("id").alias("observation_period_id"),
        F.date_add(F.lit(day(0)), (F.col("id") * 7).cast("int")).alias("observation_period_start_date"),
        F.date_add(F.lit(day(0)), (F.col("id") * 7 + 400).cast("int")).alias("observation_period_end_date"),
    )
    index = frame([(1, day(35_000)), (2, day(35_000))], "person_id int, d date")
    out = ev.require_observation(index, periods, person="person_id", date="d")
    want = [i for i in range(10_000) if i * 7 + 180 <= 35_000 and 35_000 + 180 <= i * 7 + 400]
    assert sorted(r.observation_period_id for r in out.collect()) == want and want
    plan = plan_of(out)
    assert "_level" in plan and "_bucket" in plan and "Cartesian" not in plan and "NestedLoop" not in plan


def test_a_subject_with_a_thousand_dates(spark, frame):
    rnd = random.Random(7)
    events = [(1, rnd.choice([10, 20, 30]), day(rnd.randint(-2000, 2000))) for _ in range(1500)] + [(2, 10, day(5)), (3, 20, None)]
    dates = [(1, day(d)) for d in rnd.sample(range(-1900, 1900), 1000)] + [(2, day(0)), (2, day(0)), (2, day(40)), (3, day(0)), (4, day(1)), (1, None)]
    groups = [CodeGroup("near", ("A",), before=9, after=2), CodeGroup("late", ("B",), before=0, after=0)]
    mapping = frame([(10, 1, 0), (20, 0, 1)], "concept_id long, near int, late int")
    found = flags_around_dates(
        frame(dates, "subject_id int, cohort_start_date date"),
        frame(events, "person_id int, condition_source_concept_id long, condition_start_date date"),
        mapping, groups,
    )
    got = {(r[0], r[1]): (r.near, r.late) for r in found.collect()}

    def flag(subject, date, code, before, after):
        return int(any(p == subject and c == code and e is not None and -before <= (e - date).days <= after for p, c, e in events))

    asked = {d for d in dates if d[1] is not None}
    assert got == {(s, d): (flag(s, d, 10, 9, 2), flag(s, d, 20, 0, 0)) for s, d in asked}
    assert len(got) == 1004 and found.columns == ["subject_id", "cohort_start_date", "near", "late"]


def test_a_sweep_gives_the_flags_of_the_join(frame):
    rnd = random.Random(8)
    events = frame([(rnd.randint(1, 30), rnd.choice([10, 20]), day(rnd.randint(-300, 300))) for _ in range(400)],
                   "person_id int, condition_source_concept_id long, condition_start_date date")
    dates = frame([(p, day(rnd.randint(-50, 50))) for p in range(1, 40)], "subject_id int, cohort_start_date date")
    mapping = frame([(10, 1, 0), (20, 0, 1)], "concept_id long, near int, wide int")
    groups = [CodeGroup("near", ("A",)), CodeGroup("wide", ("B",), before=0)]
    swept = rows(flags_around_dates(dates, events, mapping, groups))
    assert swept == rows(ft.window_flags(dates, events, mapping, groups))


def test_first_days_are_pruned_before_the_exchange(frame):
    df = frame([(1, day(3), 1), (1, day(1), 2), (1, day(1), 3), (2, None, 4), (2, day(9), 5), (None, day(0), 6), (3, None, 7)],
               "p int, d date, e int")
    out = ev.first_day_events(df, "p", "d")
    assert rows(out) == [(1, day(1), 2), (1, day(1), 3), (2, day(9), 5)]
    out.collect()
    plan = plan_of(out)
    assert plan.count("WindowGroupLimit") >= 2 and plan.index("Exchange") < plan.rindex("WindowGroupLimit")


@pytest.mark.parametrize("ids", ["small", "spread", "negative"])
def test_bitmaps_count_as_groups_do(spark, frame, ids):
    rnd = random.Random(9)
    make = {"small": lambda: rnd.randint(0, 300), "spread": lambda: rnd.randint(0, 10**12), "negative": lambda: rnd.randint(-70_000, 70_000)}[ids]
    pool = [make() for _ in range(200)]
    data = [(rnd.choice(pool), *(rnd.choice([0, 1, None]) for _ in "abc"), rnd.choice("xy")) for _ in range(900)] + [(None, 1, 1, 1, "x")]
    df = frame(data, "id long, a int, b int, c int, g string")
    flags = ["a", "b", "c"]
    known = df.filter("id is not null")
    assert rows(bitmaps.overlap_counts(df, "id", flags)) == rows(rs.overlap_counts(known, "id", flags))
    assert rows(bitmaps.overlap_regions(df, "id", flags)) == rows(rs.overlap_regions(known, "id", flags))
    want = known.groupBy("g").agg(F.countDistinct("id").alias("n"))
    assert rows(bitmaps.distinct_ids(df, "id", ["g"])) == rows(want)
    assert bitmaps.distinct_ids(df, "id").first().n == len({r[0] for r in data} - {None})
    assert bitmaps.dense_ids(df, "id") == (ids != "spread")
    by_ids = rs.overlap_regions(known, "id", flags, ids=known.select("id"))
    assert rows(by_ids) == rows(rs.overlap_regions(known, "id", flags))
    assert ("bitmap" in plan_of(by_ids)) == (ids != "spread")


def test_bitmaps_of_nothing(frame):
    none = frame([], "id long, a int, b int")
    assert rows(bitmaps.overlap_counts(none, "id", ["a", "b"])) == [("a", 0), ("a & b", 0), ("b", 0)]
    assert bitmaps.dense_ids(none, "id") and bitmaps.distinct_ids(none, "id").first().n == 0
    assert not bitmaps.dense_ids(frame([("x",)], "id string"), "id")
    with pytest.raises(ValueError, match="more than 6"):
        bitmaps.overlap_counts(none, "id", list("abcdefg"))


def test_ranks_of_all_variables_at_once(spark, frame):
    rng = np.random.default_rng(10)
    data = [(str(g) if g else None, float(x), int(y)) for g, x, y in zip(rng.integers(0, 3, 3000), rng.normal(size=3000), rng.integers(0, 5, 3000))]
    data += [("2", 0.25, None)] * 1500 + [("one", 7.0, None), ("none", None, None)]  # one value on a third of all rows
    df = frame(data, "g string, x double, y int").repartition(5)
    points = [0, 0.1, 0.25, 0.5, 0.9, 1]
    out = order_statistics(df, ["g"], ["x", "y"], points, [f"p{i}" for i in range(6)], StageStore(spark))
    got = {(r.g, r.variable): r[2:] for r in out.collect()}
    for g in {d[0] for d in data}:
        for at, v in ((1, "x"), (2, "y")):
            own = [d[at] for d in data if d[0] == g and d[at] is not None]
            if own:
                assert got.pop((g, v)) == pytest.approx(np.quantile(own, points), abs=1e-12)
    assert got == {}
    assert order_statistics(df.limit(0), [], ["x"], [0.5], ["m"], StageStore(spark)).collect() == []
    whole = order_statistics(df, [], ["x"], [0.5], ["m"], StageStore(spark)).collect()
    assert [r.m for r in whole] == pytest.approx([np.median([d[1] for d in data if d[1] is not None])])
