from __future__ import annotations

import math

import pytest
from conftest import day, rows
from pyspark.sql import functions as F

from indexday import functions as fn
from indexday.functions.distributions import chi_squared_tail, chi_squared_upper, normal_two_sided
from indexday.spec import CategoryRule


def test_code_patterns_take_the_dot_literally(frame):
    codes = ["G20", "G20.1", "G200", "G2010", "F05.1", "F05.10", "XG20", None]
    df = frame([(c,) for c in codes], "code string")
    hit = df.filter(fn.code_matches("code", ["G20"], ["F05.1"]))
    assert rows(hit) == [("F05.1",), ("G20",), ("G20.1",)]


def test_categories_take_the_first_match_and_leave_the_rest_null(frame):
    rules = [CategoryRule("A", (1, 2)), CategoryRule("B", (3,), ("x",)), CategoryRule("C", values=("x", "y"))]
    df = frame([(1, "x"), (3, "q"), (9, "x"), (9, "y"), (9, "q"), (None, None)], "code int, value string")
    out = df.select("code", "value", fn.categorize(rules, "code", "value"))
    assert [r[2] for r in out.collect()] == ["A", "B", "B", "C", None, None]


def test_bins_are_left_closed(frame):
    ages = [17, 18, 29, 30, 79, 80, 120, None]
    out = frame([(a,) for a in ages], "age int").select(fn.cut("age", (18, 30, 40, 50, 60, 70, 80)))
    assert [r[0] for r in out.collect()] == [None, "18-29", "18-29", "30-39", "70-79", "80+", "80+", None]
    assert fn.bin_labels((18, 30, 40)) == ["18-29", "30-39", "40+"]


def test_labels_and_flags(frame):
    df = frame([("t",), ("u",), (None,)], "s string")
    out = df.select(fn.label_to_flag("s", "t"), fn.relabel("s", None, "none"), fn.relabel("s", "u", "v"), fn.matched("s"))
    assert [tuple(r) for r in out.collect()] == [(1, "t", "t", 1), (0, "u", "v", 1), (None, "none", None, 0)]


def test_any_flag_counts_null_as_zero(frame):
    df = frame([(1, None), (None, None), (0, 0), (None, 1)], "a int, b int")
    assert df.filter(fn.any_flag("a", "b")).count() == 2


def test_strip_prefix_only_in_front(frame):
    df = frame([("HAS_X_HAS_",), ("Y",)], "s string")
    assert [r[0] for r in df.select(fn.strip_prefix("s", "HAS_")).collect()] == ["x_has_", "y"]


def test_dates(frame):
    df = frame([(day(0), day(40))], "a date, b date")
    out = df.select(fn.days_between("a", "b"), fn.days_between("b", "a"), fn.year_age("b", F.lit(1937))).first()
    assert tuple(out) == (40, -40, 83)


def test_threshold(frame):
    out = frame([(7,), (8,), (-3,), (None,)], "n int").select(fn.threshold_label("n", 7, "mild", "severe"))
    assert [r[0] for r in out.collect()] == ["mild", "severe", "mild", None]


@pytest.mark.parametrize(
    ("x", "df", "p"),
    # Upper tail points from published tables.
    [(3.841459, 1, 0.05), (5.991465, 2, 0.05), (7.814728, 3, 0.05), (12.591587, 6, 0.05), (16.811894, 6, 0.01),
     (18.307038, 10, 0.05), (2.705543, 1, 0.10), (14.067140, 7, 0.05), (0.0, 3, 1.0)],
)
def test_chi_squared_tail(x, df, p):
    assert chi_squared_upper(x, df) == pytest.approx(p, abs=1e-6)


def test_chi_squared_tail_of_large_statistics():
    assert chi_squared_upper(1e6, 200) == 0
    assert chi_squared_upper(2000, 2000) == pytest.approx(0.4958, abs=1e-4)
    assert chi_squared_upper(2000, 2001) == pytest.approx(0.5021, abs=1e-4)
    assert chi_squared_upper(math.inf, 3) == 0
    assert chi_squared_upper(1e-300, 5) == pytest.approx(1)


def test_chi_squared_tail_as_a_column(frame):
    data = [(float(x), d) for d in (1, 2, 3, 7, 10, 101, 2000) for x in (0, 1e-9, 0.3, 1, 4, 9.9, 60, 190, 900, 2000, 1e5)]
    out = frame([*data, (None, 1), (1.0, None), (1.0, 0), (math.nan, 2), (math.inf, 2)], "x double, d int")
    found = out.select("x", "d", chi_squared_tail(F.col("x"), F.col("d")).alias("p")).collect()
    for r in found[: len(data)]:
        assert r.p == pytest.approx(chi_squared_upper(r.x, r.d), rel=1e-8, abs=1e-11)
    assert [r.p for r in found[len(data) :]] == [None, None, None, None, 0.0]


def test_normal_tail():
    assert normal_two_sided(1.959963984540054) == pytest.approx(0.05, abs=1e-9)
    assert math.isnan(chi_squared_upper(1.0, 0))
