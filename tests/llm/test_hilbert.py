from __future__ import annotations

import itertools
import zlib

import pyarrow.parquet as pq
import pytest
from conftest import SMALL
from pyspark.sql import functions as F

from indexday.llm.common import prepared
from indexday.llm.hilbert import Curve, cells, shard, write_shards
from indexday.llm.queries import op4_hilbert_shards


@pytest.mark.parametrize(("n", "bits"), [(1, 4), (2, 4), (3, 3), (4, 2)])
def test_curve_visits_every_cell_step_by_step(spark, n, bits):
    curve, side = Curve.of(n), 1 << bits
    df = spark.createDataFrame(list(itertools.product(range(side), repeat=n)), ", ".join(f"c{i} int" for i in range(n)))
    found = df.withColumn("at", curve.index([F.col(f"c{i}") for i in range(n)], bits)).collect()
    cells = [r[:-1] for r in sorted(found, key=lambda r: r["at"])]
    assert sorted(r["at"] for r in found) == list(range(side**n))
    assert all(sum(abs(a - b) for a, b in zip(x, y, strict=True)) == 1 for x, y in itertools.pairwise(cells))


def check_law(found, shards):
    sizes = [0] * shards
    for r in sorted(found, key=lambda r: (r["shard"], r["slot"])):
        assert r["slot"] == sizes[r["shard"]]
        sizes[r["shard"]] += 1
    assert max(sizes) - min(sizes) <= 1


def test_edge_cases(frame):
    rows = [(i, None if i % 7 == 0 else "abc"[i % 3], i * 3 % 11, "x" * i) for i in range(100)]
    rows += [(5, "a", 1, "same")] * 40 + [(None, None, None, None)] * 3 + [(1000, "a", 2, "y" * 500_000)]
    df = frame([(*r, 7) for r in rows], "doc_id long, lang string, n long, text string, slot int")
    found = shard(df, ["lang", "n"], [F.col("doc_id")], 24).collect()
    assert len(found) == len(rows)
    check_law(found, 24)
    few = shard(df.limit(5), ["lang", "n"], [F.col("doc_id")], 24).collect()
    check_law(few, 24)
    assert shard(df.limit(0), ["lang", "n"], [F.col("doc_id")], 24).collect() == []


def test_files_prune_on_each_dimension(spark, tmp_path):
    df = spark.range(6400).select(
        "id", (F.col("id") % 80).alias("x"), F.concat(F.lit("s"), F.format_string("%02d", F.col("id") / 80)).alias("y")
    )
    write_shards(shard(df.withColumn("y", F.format_string("s%02d", (F.col("id") / 80).cast("int"))), ["x", "y"], [F.col("id")], 16), str(tmp_path / "out"))
    ranges = []
    for f in (tmp_path / "out").rglob("*.parquet"):
        group = pq.ParquetFile(f).metadata
        stats = {group.schema.column(i).name: group.row_group(0).column(i).statistics for i in range(group.num_columns)}
        ranges.append(stats)
    for name, value in (("x", 17), ("y", "s33")):
        assert sum(s[name].min <= value <= s[name].max for s in ranges) <= len(ranges) / 2


def quantile_cells(values, bits):
    """Cells by definition: a mark is the value that reaches a share of the rows, a cell the marks a value is above."""
    known = sorted(v for v in values if v is not None)
    marks = {known[-(-len(known) * i // (1 << bits)) - 1] for i in range(1, 1 << bits)} if known else set()
    return [0 if v is None else sum(m < v for m in marks) for v in values]


@pytest.mark.parametrize("bits", [1, 3, 6])
def test_texts_are_cut_at_their_quantiles(frame, bits):
    begin = "https://archive.example.org/common_crawl_"
    names = [f"{begin}{2000 + i % 20}" for i in range(300)] + [f"{begin}hot"] * 150 + [None, "", "\u00e9", "z" * 100_000]
    pages = [f"{begin}{i * 7919 % 454:05d}" for i in range(454)]
    df = frame(list(zip(names, pages, [b""] * 454, strict=True)), "name string, page string, raw binary").repartition(4)
    found = df.select("name", "page", *[c.alias(f"c{i}") for i, c in enumerate(cells(df, ["name", "page", "raw"], bits, prepared(df.sparkSession)))]).collect()
    in_bytes = [None if r.name is None else r.name.encode() for r in found]
    assert [r.c0 for r in found] == quantile_cells(in_bytes, bits)
    assert [r.c1 for r in found] == quantile_cells([r.page for r in found], bits)
    assert {r.c2 for r in found} == {0}
    if bits == 6:
        assert len({r.c0 for r in found}) > 20


def test_rows_follow_the_curve(frame):
    """Shard and slot against an order made here, cell by cell."""
    rows = [(i, f"common_crawl_{2000 + i * 31 % 20}", i * 37 % 101) for i in range(500)]
    found = shard(frame(rows, "doc_id long, source string, n long").repartition(3), ["source", "n"], [F.col("doc_id")], 7, bits=4).collect()
    across, up = quantile_cells([r[1] for r in rows], 4), quantile_cells([r[2] for r in rows], 4)

    def place(x, y):
        at, side = 0, 8
        while side:
            a, b = int(x & side > 0), int(y & side > 0)
            at += side * side * ((3 * a) ^ b)
            if b == 0:
                if a:
                    x, y = side - 1 - (x & (side - 1)), side - 1 - (y & (side - 1))
                x, y = y, x
            side //= 2
        return at

    # the curve starts in either direction
    orders = [sorted(range(500), key=lambda i, s=s: (place(*((across[i], up[i])[::s])), i)) for s in (1, -1)]
    ours = [r.doc_id for r in sorted(found, key=lambda r: (r.shard, r.slot))]
    assert ours in orders
    check_law(found, 7)


def test_query(spark):
    docs = {r.doc_id: r for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()}
    found = op4_hilbert_shards(spark, SMALL).collect()
    check_law(found, 24)
    for r in found:
        raw = docs[r.doc_id].text.encode()
        assert (r.size, r.text_crc32, r.law, r.grown_shard) == (len(raw) + 8, zlib.crc32(raw), "rows", None)
    assert len(found) == len(docs)
