from __future__ import annotations

import math

import numpy as np
import pytest
from conftest import rows

from indexday.operators import stats as st


def irls(x: np.ndarray, y: np.ndarray, offset: np.ndarray | float = 0.0) -> tuple[np.ndarray, np.ndarray, float]:
    """Logistic regression by Newton steps: coefficients, standard errors, deviance."""
    x = np.column_stack([np.ones(len(x)), x])
    b = np.zeros(x.shape[1])
    for _ in range(50):
        mu = 1 / (1 + np.exp(-(x @ b + offset)))
        h = x.T @ (x * (mu * (1 - mu))[:, None])
        b = b + np.linalg.solve(h, x.T @ (y - mu))
    dev = -2 * np.sum(np.where(y == 1, np.log(mu), np.log(1 - mu)))
    return b, np.sqrt(np.diag(np.linalg.inv(h))), dev


@pytest.fixture(scope="module")
def study():
    rng = np.random.default_rng(5)
    n = 600
    flag = rng.integers(0, 2, n)
    score = rng.integers(0, 6, n)
    sex = rng.choice(["F", "M"], n)
    band = rng.choice(["18-29", "30-39", "40-49"], n)
    logit = -0.4 + 0.8 * flag - 0.2 * score + 0.5 * (sex == "M") + 0.6 * (band == "18-29") - 0.3 * (band == "40-49")
    y = (rng.random(n) < 1 / (1 + np.exp(-logit))).astype(int)
    return y, flag, score, sex, band


@pytest.fixture
def model_rows(frame, study):
    data = [(int(y), int(f), float(s), str(g), str(b)) for y, f, s, g, b in zip(*study)]
    data += [(1, 1, None, "F", "18-29"), (0, None, 1.0, "M", "30-39")]
    return frame(data, "y int, flag int, score double, sex string, band string")


def design_matrix(study):
    y, flag, score, sex, band = study
    c1 = np.select([band == "18-29", band == "40-49"], [1, -1], 0)
    c2 = np.select([band == "30-39", band == "40-49"], [1, -1], 0)
    return np.column_stack([flag, score, sex == "M", c1, c2]).astype(float), y


def test_model_matches_newton_steps(model_rows, study):
    d = st.design(model_rows, "y", ["flag", "score"], ["sex"], ["band"])
    assert d.terms == ["flag", "score", "sex_M", "band_1", "band_2"]
    table = st.fit_logistic(model_rows, d)
    b, se, _ = irls(*design_matrix(study))
    assert [c.term for c in table] == ["(Intercept)", *d.terms]
    assert np.allclose([c.estimate for c in table], b, atol=1e-6)
    assert np.allclose([c.std_error for c in table], se, atol=1e-6)
    for c in table:
        assert c.p_value == pytest.approx(math.erfc(abs(c.estimate / c.std_error) / math.sqrt(2)))
        assert c.ci_upper - c.estimate == pytest.approx(1.959964 * c.std_error, rel=1e-6)


def test_fitted_outcome_reproduces_the_margins(model_rows, study):
    d = st.design(model_rows, "y", ["flag", "score"], ["sex"], ["band"])
    fitted = [(r.band, r.sex, r.weight * r.fitted) for r in st.fitted_outcome(model_rows, d).collect()]
    y, _, _, sex, band = study
    for level in ("18-29", "30-39", "40-49"):
        assert sum(v for b, _, v in fitted if b == level) == pytest.approx(y[band == level].sum(), abs=1e-5)
    assert sum(v for _, s, v in fitted if s == "M") == pytest.approx(y[sex == "M"].sum(), abs=1e-5)


def test_fit_summary_is_that_of_single_rows(model_rows, study):
    out = st.fit_summary(model_rows, st.design(model_rows, "y", ["flag", "score"], ["sex"], ["band"]))
    x, y = design_matrix(study)
    share = y.mean()
    assert (out.n, out.terms) == (600, 6)
    assert out.deviance == pytest.approx(irls(x, y)[2], abs=1e-6)
    assert out.null_deviance == pytest.approx(-2 * 600 * (share * np.log(share) + (1 - share) * np.log(1 - share)))
    assert out.aic == pytest.approx(out.deviance + 2 * 6)


def test_models_without_rows_or_variation(frame):
    none = frame([], "y int, x int")
    assert st.fitted_outcome(none, st.design(none, "y", ["x"])).count() == 0
    flat = frame([(0, 1), (1, 1)], "y int, x int")
    with pytest.raises(ValueError, match="no predictor varies"):
        st.fit_logistic(flat, st.design(flat, "y", ["x"]))


def test_profile_limits_lie_where_the_deviance_has_risen(model_rows, study):
    d = st.design(model_rows, "y", ["flag", "score"], ["sex"], ["band"])
    table = {c.term: c for c in st.fit_logistic(model_rows, d, interval="profile")}
    x, y = design_matrix(study)
    best = irls(x, y)[2]
    for i, term in enumerate(d.terms):
        c = table[term]
        assert c.interval == "profile" and c.ci_lower < c.estimate < c.ci_upper
        for end in (c.ci_lower, c.ci_upper):
            assert irls(np.delete(x, i, axis=1), y, x[:, i] * end)[2] - best == pytest.approx(3.841459, abs=1e-4)
    assert table["(Intercept)"].interval == "wald"
    some = {c.term: c for c in st.fit_logistic(model_rows, d, interval="profile", profiled=["flag"])}
    assert some["flag"].ci_upper == pytest.approx(table["flag"].ci_upper) and some["score"].interval == "wald"


def counted(frame, counts):
    """A row per person from the treated and all persons of each group."""
    cells = [(g, y, n) for g, (t, whole) in counts.items() for y, n in ((1, t), (0, whole - t))]
    return frame(cells, "g string, y int, n int").selectExpr("g", "y", "explode(sequence(1, n)) as person")


def logit(share):
    return math.log(share / (1 - share))


def rise_at(counts, contrast, value):
    """Rise of the deviance of a model with a term per group when a contrast of the groups' logits is held at a value."""

    def shares(m):
        return [(t + m * c) / n for (t, n), c in zip(counts, contrast)]

    low = max(-t / c if c > 0 else (n - t) / c for (t, n), c in zip(counts, contrast) if c)
    high = min((n - t) / c if c > 0 else -t / c for (t, n), c in zip(counts, contrast) if c)
    for _ in range(200):
        m = (low + high) / 2
        above = sum(c * logit(p) for p, c in zip(shares(m), contrast)) > value
        low, high = (low, m) if above else (m, high)
    pairs = [(t, n, p) for (t, n), p in zip(counts, shares(m))]
    return 2 * sum(t * math.log(t / n / p) + (n - t) * math.log((1 - t / n) / (1 - p)) for t, n, p in pairs)


def test_contrasts_of_large_groups_are_plotted(frame):
    counts = {"a": (1600, 4000), "b": (2100, 4100), "c": (1500, 4200), "d": (1650, 4300)}
    df = counted(frame, counts)
    d = st.design(df, "y", summed=["g"])
    out = {r["group"]: r for r in st.plot_table(st.fit_logistic(df, d, interval="profile"), "g", d.summed["g"])}
    mean = sum(logit(t / n) for t, n in counts.values()) / 4
    assert set(out) == {f"{g} vs g grand mean" for g in "abc"}
    for i, g in enumerate("abc"):
        r = out[f"{g} vs g grand mean"]
        assert r["coefficient"] == pytest.approx(logit(counts[g][0] / counts[g][1]) - mean, abs=1e-7)
        contrast = [(k == i) - 1 / 4 for k in range(4)]
        for end in (r["lower"], r["upper"]):
            assert rise_at(list(counts.values()), contrast, end) == pytest.approx(3.841459, abs=1e-5)
        assert r["significant"] == (r["lower"] > 0 or r["upper"] < 0)


@pytest.mark.parametrize("times", [1, 200])
def test_contrast_limits_of_any_number_of_rows(frame, times):
    counts = {"a": (20 * times, 60 * times), "b": (31 * times, 62 * times), "c": (21 * times, 70 * times)}
    df = counted(frame, counts)
    table = {c.term: c for c in st.fit_logistic(df, st.design(df, "y", summed=["g"]), interval="profile")}
    mean = sum(logit(t / n) for t, n in counts.values()) / 3
    for i, g in enumerate("ab"):
        c = table[f"g_{i + 1}"]
        assert c.converged and c.estimate == pytest.approx(logit(counts[g][0] / counts[g][1]) - mean, abs=1e-7)
        contrast = [(k == i) - 1 / 3 for k in range(3)]
        variance = sum(w * w * (1 / t + 1 / (n - t)) for w, (t, n) in zip(contrast, counts.values()))
        assert c.std_error == pytest.approx(math.sqrt(variance), rel=1e-6)
        for end in (c.ci_lower, c.ci_upper):
            assert rise_at(list(counts.values()), contrast, end) == pytest.approx(3.841459, abs=1e-5)


def test_limits_of_two_large_groups(frame):
    counts = {"mild": (6720, 19490), "severe": (3400, 9900)}
    df = counted(frame, counts)
    first, second = st.fit_logistic(df, st.design(df, "y", dummy={"g": ["mild", "severe"]}), interval="profile")
    mild, severe = (logit(t / n) for t, n in counts.values())
    assert first.estimate == pytest.approx(mild, abs=1e-7) and second.estimate == pytest.approx(severe - mild, abs=1e-7)
    assert first.std_error == pytest.approx(math.sqrt(1 / 6720 + 1 / 12770), rel=1e-6)
    assert second.converged and second.ci_lower < second.estimate < second.ci_upper
    for end in (second.ci_lower, second.ci_upper):
        assert rise_at(list(counts.values()), [-1, 1], end) == pytest.approx(3.841459, abs=1e-5)


def test_ends_not_reached_are_missing(model_rows, monkeypatch):
    monkeypatch.setattr(st, "MAX_PROFILE_STEPS", 1)
    d = st.design(model_rows, "y", ["flag", "score"])
    flag = next(c for c in st.fit_logistic(model_rows, d, interval="profile") if c.term == "flag")
    assert (flag.ci_lower, flag.ci_upper, flag.interval) == (None, None, "profile")


def test_a_fit_that_does_not_converge_says_so(model_rows, monkeypatch):
    monkeypatch.setattr(st, "MAX_ITERATIONS", 1)
    table = st.fit_logistic(model_rows, st.design(model_rows, "y", ["flag", "score"]))
    assert not any(c.converged or c.separated for c in table)


def test_coefficient_frame_has_odds_ratios(spark):
    out = st.coefficient_frame(spark, [st.Coefficient("x", 0.6, 0.1, 6.0, 0.0, 0.4, 0.8)]).first()
    assert round(out.odds_ratio, 2) == 1.82
    assert round(st.odds_ratio(0.6), 2) == 1.82


def test_redundant_terms_have_no_estimate(frame):
    data = [(y, a, 2 * a, 1, b) for y, a, b in [(0, 0, 0), (1, 0, 1), (0, 1, 1), (1, 1, 0), (1, 1, 1), (0, 0, 1), (1, 0, 0)] * 5]
    df = frame(data, "y int, a int, twice int, one int, b int")
    table = {c.term: c for c in st.fit_logistic(df, st.design(df, "y", ["a", "twice", "one", "b"]))}
    assert table["twice"].estimate is None and table["one"].estimate is None
    plain = {c.term: c for c in st.fit_logistic(df, st.design(df, "y", ["a", "b"]))}
    assert table["a"].estimate == pytest.approx(plain["a"].estimate)
    assert table["b"].std_error == pytest.approx(plain["b"].std_error)


def test_levels_without_complete_rows_are_not_coded(frame):
    df = frame([(1, "a", 1.0), (0, "b", 2.0), (1, "c", None)], "y int, g string, x double")
    assert st.design(df, "y", ["x"], summed=["g"]).summed == {"g": ["a", "b"]}


def test_too_many_levels_are_refused(frame):
    df = frame([("a", 1), ("b", 0), ("c", 1)], "g string, y int")
    with pytest.raises(ValueError, match="more than 2"):
        st.level_values(df, "g", max_levels=2)
    with pytest.raises(ValueError, match="more than 2"):
        st.design(df, "y", dummy=["g"], max_levels=2)


def test_ordered_levels_name_the_contrasts(frame):
    order = ["5-17", "18-29", "30+", "never"]
    data = [(y, g) for g, treated in (("5-17", 6), ("18-29", 3), ("30+", 2)) for y in [1] * treated + [0] * (10 - treated)]
    df = frame(data, "y int, g string")
    d = st.design(df, "y", summed={"g": order})
    assert d.summed == {"g": ["5-17", "18-29", "30+"]}
    rows_ = st.plot_table(st.fit_logistic(df, d), "g", d.summed["g"])
    logit = {g: math.log(t / (10 - t)) for g, t in (("5-17", 6), ("18-29", 3), ("30+", 2))}
    mean = sum(logit.values()) / 3
    assert {r["group"]: pytest.approx(r["coefficient"], abs=1e-6) for r in rows_} == {
        f"{g} vs g grand mean": logit[g] - mean for g in ("5-17", "18-29")
    }
    with pytest.raises(ValueError, match="without a place"):
        st.design(df, "y", summed={"g": order[:2]})


def test_subgroups_are_fitted_on_their_own(model_rows, study):
    fits = st.fit_by_group(model_rows.withColumn("other", model_rows.flag * 0), ["flag", "other"], "y", ["score"])
    assert fits["other"] == []
    y, flag, score, *_ = study
    keep = flag == 1
    b, _, _ = irls(score[keep][:, None].astype(float), y[keep])
    assert [c.estimate for c in fits["flag"]] == pytest.approx(list(b), abs=1e-6)


def test_patterns_keep_complete_rows_only(model_rows):
    weights = st.covariate_patterns(model_rows, "y", ["flag", "score"])
    assert weights.agg({"weight": "sum"}).first()[0] == 600


def test_contrasts(frame):
    df = frame([("a",), ("b",), ("c",), (None,)], "g string")
    out = rows(st.sum_contrasts(df, "g", ["a", "b", "c"]))
    assert out == [("a", 1, 0), ("b", 0, 1), ("c", -1, -1), (None, None, None)]
    assert rows(st.dummies(df, "g", ["a", "b", "c"])) == [("a", 0, 0), ("b", 1, 0), ("c", 0, 1), (None, None, None)]


def test_plot_table_checks_its_labels():
    table = [st.Coefficient("(Intercept)", 1.0, 1, 1, 0.3, 0, 2), st.Coefficient("x", 2.0, 1, 2, 0.04, 0.1, 3.9),
             st.Coefficient("age_group_1", 0.1, 1, 0.1, 0.9, -1, 1)]
    out = st.plot_table(table, "age_group", ["18-29", "30+"])
    assert [(r["group"], r["significant"]) for r in out] == [("x", True), ("18-29 vs age_group grand mean", False)]
    with pytest.raises(ValueError, match="expected 2"):
        st.plot_table(table, "age_group", ["18-29", "30-39", "40+"])


def chi2(table, correct=False):
    t = np.array(table, float)
    e = t.sum(1)[:, None] * t.sum(0)[None, :] / t.sum()
    gap = np.abs(t - e)
    if correct:
        gap = gap - min(0.5, gap.min())
    return float((gap**2 / e).sum())


@pytest.mark.parametrize(
    "table",
    [[[10, 20], [30, 15]], [[3, 4], [4, 3]], [[12, 5], [0, 9]], [[5, 1], [2, 8], [7, 7]], [[4, 0], [0, 3], [2, 2]],
     [[1, 6], [2, 5], [3, 4], [4, 3], [5, 2], [6, 1], [7, 7]]],
)
def test_chi_squared(frame, table):
    data = [(f"r{i}", j) for i, row in enumerate(table) for j, n in enumerate(row) for _ in range(n)]
    df = frame([*data, (None, 1), ("r0", None)], "p string, y int")
    two = len(table) == 2
    for correct in (True, False):
        r = st.crosstab_test(df, ["p"], "y", correct).first()
        assert r.statistic == pytest.approx(chi2(table, correct and two), abs=1e-9)
        assert r.df == len(table) - 1


def test_tables_of_one_line_are_tested_for_equal_counts(frame):
    r = st.crosstab_test(frame([("a", 1)] * 9 + [("a", 0)] * 3, "p string, y int"), ["p"], "y").first()
    assert (r.statistic, r.df) == (3.0, 1) and r.p_value == pytest.approx(math.erfc(math.sqrt(1.5)))
    r = st.crosstab_test(frame([("a", 1)] * 5 + [("b", 1)] * 2 + [("c", 1)] * 2, "p string, y int"), ["p"], "y").first()
    assert (r.statistic, r.df) == (2.0, 2) and r.p_value == pytest.approx(math.exp(-1))
    r = st.crosstab_test(frame([("a", 1)] * 4, "p string, y int"), ["p"], "y").first()
    assert (r.statistic, r.df, r.p_value) == (None, 0, None)
