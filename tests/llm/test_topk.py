from __future__ import annotations

import math

import pytest
from pyspark.sql import functions as F

from indexday.llm import topk
from indexday.llm.topk import top_k


def brute(rows, k, every):
    ok = [(i, [math.floor(1024 * x) for x in v]) for i, v in rows
          if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for q, a in ok:
        if q % every:
            continue
        hits = sorted((-sum(x * y for x, y in zip(a, b, strict=False)), i) for i, b in ok if i != q)
        out += [(q, n + 1, i, -s) for n, (s, i) in enumerate(hits[:k])]
    return sorted(out)


def vectors():
    rows = [(i, [math.sin(i * j + 1) / 2 for j in range(6)]) for i in range(60)]
    rows += [(60, None), (61, [0.1, None, 0.2, 0.0, 0.0, 0.0]), (62, [float("nan")] * 6), (63, [float("inf")] + [0.0] * 5)]
    rows += [(64, [0.0] * 6), (65, [0.0] * 6), (66, rows[6][1]), (67, rows[6][1]), (68, [0.5, 0.5]), (None, [0.3] * 6)]
    return rows


@pytest.mark.parametrize("block_bytes", [topk.QUERY_BLOCK_BYTES, 200])
def test_against_brute_force(spark, frame, block_bytes):
    rows = vectors()
    df = frame([(*r, "x") for r in rows], "vec_id long, embedding array<double>, score string").repartition(5)
    found = top_k(df, F.col("vec_id") % 4 == 0, k=5, block_bytes=block_bytes)
    assert found.columns == ["query_id", "rank", "vec_id", "score"]
    assert sorted(map(tuple, found.collect())) == brute(rows, 5, 4)


def test_fewer_rows_than_k_and_repeated_queries(frame):
    df = frame([(0, [1.0]), (0, [1.0]), (1, [1.0]), (1, [1.0])], "vec_id long, embedding array<float>")
    found = top_k(df, F.col("vec_id") == 0, k=10).collect()
    assert sorted(map(tuple, found)) == [(0, 1, 1, 1 << 20), (0, 2, 1, 1 << 20)]


def test_empty(frame):
    df = frame([], "vec_id long, embedding array<float>")
    assert top_k(df, F.col("vec_id") == 0).collect() == []
