from __future__ import annotations

import math
from itertools import combinations

import numpy as np
import pytest

from indexday.operators import stats as st


def rays(x, y):
    """Extreme separating directions of a small full-rank design, by trying every set of rows that could bound one."""
    signed = x * (2 * y - 1)[:, None]
    signed = np.unique(signed, axis=0)
    size, found = x.shape[1], []
    for some in combinations(range(len(signed)), size - 1):
        _, values, vectors = np.linalg.svd(signed[list(some)])
        if (values > 1e-9).sum() < size - 1:
            continue
        for d in (vectors[-1], -vectors[-1]):
            shift = signed @ d
            if shift.min() > -1e-9 and shift.max() > 1e-9:
                found.append(d)
    return found


def newton(x, y, w):
    b = np.zeros(x.shape[1])
    for _ in range(60):
        p = 1 / (1 + np.exp(-x @ b))
        b = b + np.linalg.pinv((x.T * (w * p * (1 - p))) @ x) @ (x.T @ (w * (y - p)))
    return b


CASES = {
    "overlapping": [(0, 0, 0), (1, 0, 0), (0, 1, 0), (1, 1, 1), (0, 0, 1), (1, 0, 1), (1, 1, 0), (0, 1, 1)],
    "one level decided": [(0, 0, 0), (1, 0, 0), (0, 0, 1), (1, 0, 1), (1, 0, 1), (1, 1, 0), (1, 1, 1)],
    "a cell of the interaction": [(0, 0, 0), (1, 0, 0), (0, 1, 0), (1, 1, 0), (1, 0, 1), (0, 0, 1), (1, 1, 1)],
    "a line with a common point": [(0, 0, 0), (0, 1, 0), (0, 2, 1), (1, 2, 1), (1, 3, 0), (1, 4, 1), (0, 2, 0), (1, 2, 0)],
    "all decided": [(0, 0, 0), (0, 1, 0), (0, 0, 1), (1, 3, 0), (1, 4, 1), (1, 3, 2)],
    "two steps": [(0, 0, 0), (1, 0, 0), (0, 1, 0), (1, 2, 0), (0, 0, 1), (0, 1, 1), (0, 5, 2), (0, 7, 2)],
    "only the intercept is left": [(0, 0, 0), (1, 0, 0), (1, 0, 0), (1, 1, 0), (1, 0, 1), (1, 1, 1)],
}


@pytest.mark.parametrize("name", CASES)
def test_infinite_terms_by_brute_force(frame, name):
    data = CASES[name] * 3
    rows = np.array(data, float)
    y, x = rows[:, 0], np.column_stack([rows[:, 1:], np.ones(len(rows))])
    found = rays(x, y)
    infinite = np.abs(np.array(found)).max(axis=0) > 1e-9 if found else np.zeros(3, bool)
    df = frame(data, "y int, a int, b int").coalesce(1)
    d = st.design(df, "y", ["a", "b"])
    table = {c.term: c for c in st.fit_logistic(df, d)}
    assert [table[t].separated for t in ("a", "b", st.INTERCEPT)] == infinite.tolist()
    assert all(c.converged for c in table.values())
    # the others are the coefficients of the rows that no direction moves
    stand = np.abs(x @ np.array(found).T).max(axis=1) < 1e-9 if found else np.ones(len(y), bool)
    left = newton(x[stand], y[stand], np.ones(stand.sum())) if stand.any() else None
    for i, t in enumerate(("a", "b", st.INTERCEPT)):
        c = table[t]
        if infinite[i]:
            assert (c.estimate, c.std_error, c.p_value, c.ci_lower, c.ci_upper, c.interval) == (None,) * 6
        else:
            assert c.estimate == pytest.approx(left[i], abs=1e-5) and c.std_error > 0
    # fitted probabilities and deviance are the limits
    fitted = {(r.a, r.b): r.fitted for r in st.fitted_outcome(df, d).collect()}
    want = np.where(stand, 1 / (1 + np.exp(-x @ left)), y) if left is not None else y
    for (_, a, b), p in zip(data, want):
        assert fitted[a, b] == pytest.approx(p, abs=1e-6)
    p = np.clip(want, 1e-300, 1 - 1e-16)
    deviance = -2 * sum(math.log(q if t else 1 - q) for q, t, s in zip(p, y, stand) if s)
    out = st.fit_summary(df, d)
    assert (out.n, out.terms) == (len(y), 3) and out.deviance == pytest.approx(deviance, abs=1e-6)
    assert out.aic == pytest.approx(deviance + 6, abs=1e-6)


def test_profile_limits_beside_a_separated_term(frame):
    """The finite term has the limits of the model without the separated level."""
    rng = np.random.default_rng(8)
    data = [(int(rng.random() < 0.3 + 0.1 * x), x, "m" if i % 2 else "n") for i, x in enumerate([0, 1, 2, 3] * 20)]
    whole = frame([*data, *[(1, x, "sure") for x in (0, 1, 2)]], "y int, x int, g string")
    table = {c.term: c for c in st.fit_logistic(whole, st.design(whole, "y", ["x"], ["g"]), interval="profile")}
    part = frame(data, "y int, x int, g string")
    alone = {c.term: c for c in st.fit_logistic(part, st.design(part, "y", ["x"], ["g"]), interval="profile")}
    assert table["g_sure"].separated and not table["x"].separated
    for t in ("x", "g_n"):
        assert (table[t].interval, table[t].converged) == ("profile", True)
        for figure in ("estimate", "std_error", "ci_lower", "ci_upper"):
            assert getattr(table[t], figure) == pytest.approx(getattr(alone[t], figure), abs=1e-6)


def test_certificate(frame):
    rng = np.random.default_rng(9)
    data = [(int(rng.random() < 0.2 + 0.15 * x), x, int(rng.integers(0, 2))) for x in [0, 1, 2, 3, 4] * 16]
    df = frame(data, "y int, x int, z int")
    d = st.design(df, "y", ["x", "z"])
    table = {c.term: c for c in st.fit_logistic(df, d, interval="profile")}
    found = st.profile_certificate(df, d).collect()
    assert sorted((r.term, r.side) for r in found) == [(t, s) for t in ("x", "z") for s in ("lower", "upper")]
    for r in found:
        c = table[r.term]
        assert r.limit == pytest.approx(c.ci_lower if r.side == "lower" else c.ci_upper)
        assert (r.reached, r.beyond) == (True, True)
        assert r.deviance_rise == pytest.approx(st.CHI2_95, abs=1e-6) and r.steepest < 1e-6
    sure = frame([(int(x > 2), x, z) for x in range(6) for z in (0, 1)], "y int, x int, z int")
    assert st.profile_certificate(sure, st.design(sure, "y", ["x", "z"])).collect() == []
    assert st.profile_certificate(df.limit(0), st.Design("y", ("x",), {}, {})).collect() == []
