from __future__ import annotations

import math

import numpy as np
import pytest

from indexday.llm import queries
from indexday.llm.whitening import count_below, leading_components, leading_values, tridiagonal, whiten

SCHEMA = "vec_id long, embedding array<float>"


def symmetric(kind, n, rng):
    a = rng.normal(size=(n, n))
    q, _ = np.linalg.qr(a)
    return {
        "full": a @ a.T,
        "identity": np.eye(n),
        "repeated values": q @ np.diag(rng.integers(1, 4, n).astype(float)) @ q.T,
        "low rank": a[:, : n // 3 + 1] @ a[:, : n // 3 + 1].T,
        "diagonal": np.diag(rng.integers(0, 3, n).astype(float)),
        "close values": q @ np.diag(1 + 1e-9 * rng.random(n)) @ q.T,
    }[kind]


@pytest.mark.parametrize("kind", ["full", "identity", "repeated values", "low rank", "diagonal", "close values"])
def test_components_solve_the_matrix(kind):
    rng = np.random.default_rng(5)
    for n in (1, 2, 3, 17, 40):
        a = symmetric(kind, n, rng)
        a = (a + a.T) / 2 * 10.0 ** rng.integers(-3, 9)
        k = min(n, 16)
        values, axes = leading_components(a, k)
        expected = np.linalg.eigvalsh(a)[::-1][:k]
        size = max(np.abs(expected).max(), 1e-300)
        assert np.abs(values - expected).max() / size < 1e-13 * max(n, 4)
        assert np.abs(a @ axes - axes * values).max() / size < 1e-12
        assert np.abs(axes.T @ axes - np.eye(k)).max() < 1e-12


def test_sturm_counts_and_bisection():
    rng = np.random.default_rng(6)
    a = symmetric("full", 12, rng)
    diagonal, off, _ = tridiagonal(a)
    values = np.linalg.eigvalsh(a)
    at = np.concatenate([values - 1e-6, values + 1e-6])
    assert count_below(diagonal, off, at).tolist() == [*range(12), *range(1, 13)]
    assert np.allclose(leading_values(diagonal, off, 5), values[::-1][:5], rtol=1e-13)


def expected(rows, k=16):
    """Everything by numpy and whole numbers: {row number: (deviation, whitened)}, n and explained."""
    good = {
        i: [math.floor(64 * float(np.float32(c))) + 1_000_000 for c in v]
        for i, (_, v) in enumerate(rows)
        if v is not None and all(c is not None and math.isfinite(c) for c in v)
    }
    fit = np.array(sorted(set(map(tuple, good.values()))), np.int64)
    n, sums = len(fit), fit.sum(axis=0)
    centred = fit - sums / n
    v = centred.T @ centred / n
    values, axes = np.linalg.eigh(v)
    values, axes = values[::-1][:k], axes[:, ::-1][:, :k]
    out = {}
    for i, x in good.items():
        deviation = sum((n * c - int(s)) ** 2 for c, s in zip(x, sums.tolist(), strict=True))
        out[i] = (deviation, (np.array(x) - sums / n) @ axes / np.sqrt(values))
    return out, n, values / np.trace(v)


def check(found, rows, k=16):
    want, n, explained = expected(rows, k)
    by_id = {}
    for r in found:
        by_id.setdefault(r["vec_id"], {})[r["component"]] = r
    assert sorted(by_id) == sorted(want)
    k = len(explained)
    ours = np.array([[by_id[i][c]["whitened"] for c in range(1, k + 1)] for i in sorted(want)])
    theirs = np.array([want[i][1] for i in sorted(want)])
    signs = np.sign((ours * theirs).sum(axis=0))
    assert np.abs(ours - theirs * signs).max() < 1e-8
    for i in want:
        assert {r["deviation"] for r in by_id[i].values()} == {want[i][0]}
        assert {r["n"] for r in by_id[i].values()} == {n}
        assert np.allclose([by_id[i][c]["explained"] for c in range(1, k + 1)], explained, rtol=1e-10)
    errors = {r["identity_error"] for r in found}
    assert len(errors) == 1 and errors.pop() < 1e-9


def made_up(n, d, seed=0):
    rng = np.random.default_rng(seed)
    base = rng.normal(size=(n, d)) @ rng.normal(size=(d, d))
    return [(i, [float(c) for c in v]) for i, v in enumerate(base)]


def test_query_by_brute_force(spark, tmp_path):
    rows = made_up(300, 24)
    rows += [(300 + i, rows[7][1]) for i in range(150)]  # a third of all rows are copies: once in the fit list
    rows += [(450, None), (451, [None, *rows[0][1][1:]]), (452, [float("nan"), *rows[0][1][1:]]), (453, [float("inf"), *rows[0][1][1:]])]
    frame = spark.createDataFrame(rows, SCHEMA)
    frame.selectExpr("*", "1 AS label", "'clash' AS component").repartition(5).write.parquet(str(tmp_path / "embeddings.parquet"))
    check(queries.op13_whitening(spark, str(tmp_path)).collect(), rows)


def test_low_rank_and_small_tables(spark):
    flat = [(i, [float(i), 2.0 * i, 5.0]) for i in range(6)]  # one direction of variance
    found = whiten(spark.createDataFrame(flat, SCHEMA)).collect()
    assert {r["component"] for r in found} == {1} and len(found) == 6
    assert abs(found[0]["explained"] - 1) < 1e-12
    for few in ([], flat[:1], flat[:1] * 4, [(1, None)], [(1, [])]):
        assert whiten(spark.createDataFrame(few, SCHEMA)).collect() == []


def test_repeated_ids_other_lengths_and_order(spark):
    rows = made_up(40, 5, seed=3)
    odd = [(3, rows[3][1]), (None, rows[4][1]), (90, [1.0, 2.0]), (91, [])]
    got = whiten(spark.createDataFrame(rows + odd, SCHEMA)).collect()
    assert len(got) == 42 * 5
    check([r for r in got if r["vec_id"] is not None], rows, k=16)
    again = whiten(spark.createDataFrame(list(reversed(rows)), SCHEMA)).collect()
    first = {(r["vec_id"], r["component"]): r["whitened"] for r in got}
    assert all(abs(first[r["vec_id"], r["component"]] - r["whitened"]) < 1e-8 for r in again)


def test_deviations_beyond_a_long_are_null(spark):
    rows = [(i, [float(2.0**40 * i), float(i * i)]) for i in range(4)]
    got = {r["vec_id"]: r["deviation"] for r in whiten(spark.createDataFrame(rows, SCHEMA)).collect()}
    want, _, _ = expected(rows)
    assert got == {i: d if d < 2**63 else None for i, (d, _) in want.items()}
    assert None in got.values()
