from __future__ import annotations

import numpy as np
import pytest

from indexday.llm import components as components_module
from indexday.llm import nndescent
from indexday.llm.components import components
from indexday.llm.common import prepared
from indexday.llm.nndescent import near_duplicates
from indexday.llm.queries import op8_embedding_duplicates

SCHEMA = "vec_id long, embedding array<double>"


def brute(rows, threshold=0.95):
    usable = []
    for at, (i, v) in enumerate(rows):
        if i is not None and v is not None and all(x is not None and np.isfinite(x) for x in v) and any(v):
            scaled = np.array(v) / np.abs(v).max()
            usable.append((at, i, scaled / np.linalg.norm(scaled)))
    parent, links = list(range(len(rows))), [0] * len(rows)

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in range(len(usable)):
        for b in range(a):
            (x, _, u), (y, _, v) = usable[a], usable[b]
            if u @ v >= threshold:
                links[x] += 1
                links[y] += 1
                parent[root(x)] = root(y)
    least = {}
    for at, i, _ in usable:
        least[root(at)] = min(i, least.get(root(at), i))
    return sorted((str(i), links[at], str(least.get(root(at), i))) for at, (i, _) in enumerate(rows))


def check(df, rows):
    found = near_duplicates(df)
    got = found.links.collect()
    assert sorted((str(r.vec_id), r.n_links, str(r.component_id)) for r in got) == brute(rows)
    assert all(r.kept == (r.vec_id == r.component_id) if r.vec_id is not None else r.kept is None for r in got)
    assert found.recall == 1.0


def test_families_of_many_widths(frame):
    rng = np.random.default_rng(3)
    rows = [(i, rng.standard_normal(16).tolist()) for i in range(200)]
    for f, (size, spread) in enumerate([(40, 0.02), (30, 0.1), (25, 0.2), (2, 0.01), (60, 0.15)]):
        base = rng.standard_normal(16)
        rows += [(1000 * (f + 1) + j, (base + spread * rng.standard_normal(16)).tolist()) for j in range(size)]
    check(frame([(*r, 1) for r in rows], SCHEMA + ", unit int").repartition(5), rows)


def test_edge_cases(frame):
    e = [1.0, 0.0, 0.0]
    rows = [(i, e) for i in range(5)] + [(7, [2.0, 0.0, 0.0]), (7, [0.0, 1.0, 0.0]), (8, [0.0, 3.0, 1e-9]), (None, e), (9, None)]
    rows += [(10, [0.0] * 3), (11, [float("nan"), 1.0, 0.0]), (12, [None, 1.0, 0.0]), (13, [float("inf"), 0.0, 0.0]), (14, [])]
    rows += [(15, [1e-300, 0.0, 1e-300]), (16, [1e300, 0.0, 1e300])]
    check(frame(rows, SCHEMA), rows)


def test_empty(frame):
    assert near_duplicates(frame([], SCHEMA)).links.collect() == []
    only = near_duplicates(frame([(1, None)], SCHEMA)).links.collect()
    assert [tuple(r) for r in only] == [(1, 0, 1, True)]


def test_large_family_is_pieced_together(frame, monkeypatch):
    monkeypatch.setattr(nndescent, "LEAF", 16)
    monkeypatch.setattr(nndescent, "NEIGHBOURS", 4)
    rng = np.random.default_rng(5)
    base = rng.standard_normal(8)
    rows = [(i, (base + 0.03 * rng.standard_normal(8)).tolist()) for i in range(300)]
    check(frame(rows, SCHEMA), rows)


@pytest.mark.parametrize(("n", "last"), [(1, 0), (50, 0), (50, 20), (50, 1_000_000)])
def test_components_of_a_path_a_star_and_a_circle(spark, frame, monkeypatch, n, last):
    monkeypatch.setattr(components_module, "LAST_EDGES", last)
    edges = [(i, i + 1) for i in range(n)] + [(1000, 1000 + i) for i in range(1, n + 1)] + [(2000 + i, 2000 + (i + 1) % n) for i in range(n)]
    found = components(frame(edges, "a long, b long"), prepared(spark)).collect()
    want = {i: 0 for i in range(n + 1)} | {1000 + i: 1000 for i in range(n + 1)} | ({2000 + i: 2000 for i in range(n)} if n > 1 else {})
    assert {r.id: r.component for r in found} == want


def test_families_linked_at_their_borders_only(frame):
    """Pairs of tight families, first vectors beyond the threshold's angle, with one link between border members."""
    rng = np.random.default_rng(11)
    rows = []
    for size in [30] * 12 + [400]:
        x, y = np.linalg.qr(rng.standard_normal((32, 2)))[0].T
        degrees = [*rng.uniform(0, 2, size), 6.0, 10.0, 27.5, 31.0, *rng.uniform(36, 38, size)]
        for d in degrees:
            noise = 0.002 * rng.standard_normal(32)
            rows.append((len(rows), (np.cos(np.radians(d)) * x + np.sin(np.radians(d)) * y + noise).tolist()))
    check(frame(rows, SCHEMA).repartition(5), rows)


def test_query_equals_brute_force(spark, frame, tmp_path):
    """The registered query on a table of single vectors, families of several widths, repeated and unusable rows."""
    rng = np.random.default_rng(17)
    rows = [(i, rng.standard_normal(24).astype(np.float32).tolist()) for i in range(150)]
    for size, spread in [(90, 0.05), (20, 0.2), (2, 0.01), (2, 0.1), (3, 0.22)]:
        base = rng.standard_normal(24)
        rows += [(len(rows) + j, (base + spread * rng.standard_normal(24)).astype(np.float32).tolist()) for j in range(size)]
    rows += [rows[3], (900, rows[3][1]), (901, None), (902, [0.0] * 24), (903, [float("nan")] * 24), (904, [None] * 24)]
    table = frame([(i, v, i % 3) for i, v in rows], "vec_id long, embedding array<float>, label int")
    table.repartition(3).write.parquet(f"{tmp_path}/embeddings.parquet")
    got = op8_embedding_duplicates(spark, str(tmp_path)).collect()
    assert sorted((str(r.vec_id), r.n_links, str(r.component_id)) for r in got) == brute(rows)
    assert all(r.kept == (r.vec_id == r.component_id) for r in got)


def test_recall_is_told_by_family_size(frame):
    big = [(a, b, 1.0) for a in range(30) for b in range(30) if a != b]
    pairs = [p for i in range(3) for p in [(100 + 2 * i, 101 + 2 * i, 1.0), (101 + 2 * i, 100 + 2 * i, 1.0)]]
    truth, labels = frame(big + pairs, "id long, other long, sim float"), frame([(i, 0) for i in range(30)], "id long, component long")
    assert nndescent._recall(truth, labels) == 0.0  # all pairs taken together: 0.993
    found = frame([(i, 0) for i in range(30)] + [(i, i // 2 * 2) for i in range(100, 106)], "id long, component long")
    assert nndescent._recall(truth, found) == 1.0


def test_missed_recall_raises(frame, monkeypatch):
    kept = nndescent._kept
    monkeypatch.setattr(nndescent, "ROUNDS", 2)
    monkeypatch.setattr(nndescent, "_kept", lambda *args: kept(*args).filter("false"))
    with pytest.raises(RuntimeError, match="recall"):
        near_duplicates(frame([(i, [1.0, i / 1000]) for i in range(20)], SCHEMA))
