"""Distinct ids and overlaps of sets as bitmaps."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from itertools import combinations, product

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BUCKET_IDS = 8 * 4096  # ids of one bitmap
MAX_SETS = 6


def dense_ids(ids: DataFrame, key: str) -> bool:
    """Whether bitmaps of these whole-number ids take less room than the ids: few buckets, or well filled ones."""
    if ids.schema[key].dataType.typeName() not in ("byte", "short", "integer", "long"):
        return False
    found = ids.agg(F.min(key).alias("lo"), F.max(key).alias("hi"), F.approx_count_distinct(key).alias("n")).first()
    if found.lo is None:
        return True
    buckets = (found.hi - found.lo) // BUCKET_IDS + 1
    return buckets <= 16 or buckets * 1024 <= found.n


def distinct_ids(df: DataFrame, key: str, by: Sequence[str] = (), name: str = "n") -> DataFrame:
    """Exact number of distinct ids per group, NULLs left out.

    A task sets the bits of its ids in one bitmap per 32,768 ids; bitmaps are merged by bucket and their bits counted. What
    shuffles is 4 kB per bucket, group and task, however many rows there are, so this is for dense ids (see :func:`dense_ids`).
    """
    bucketed = df.filter(F.col(key).isNotNull()).groupBy(*by, F.bitmap_bucket_number(key).alias("_bucket"))
    maps = bucketed.agg(F.bitmap_construct_agg(F.bitmap_bit_position(key)).alias("_bits"))
    return maps.groupBy(*by).agg(F.coalesce(F.sum(F.bitmap_count("_bits")), F.lit(0)).cast("long").alias(name))


def _unions(df: DataFrame, key: str, flags: Sequence[str]) -> tuple[DataFrame, dict[tuple[str, ...], Column]]:
    """One row with the number of distinct ids in the union of every choice of sets, and its columns by choice.

    Bits are only ever joined: a union needs no second look at an id, and intersections follow from unions.
    """
    if len(flags) > MAX_SETS:
        raise ValueError(f"more than {MAX_SETS} sets")
    choices = [c for k in range(1, len(flags) + 1) for c in combinations(flags, k)]
    at = F.bitmap_bit_position(key)
    bits = [
        F.bitmap_construct_agg(F.when(reduce(lambda a, b: a | b, [F.col(f) == 1 for f in c]), at)).alias(f"_b{i}")
        for i, c in enumerate(choices)
    ]
    maps = df.filter(F.col(key).isNotNull()).groupBy(F.bitmap_bucket_number(key).alias("_bucket")).agg(*bits)
    sums = [F.coalesce(F.sum(F.bitmap_count(f"_b{i}")), F.lit(0)).alias(f"_u{i}") for i in range(len(choices))]
    return maps.agg(*sums), {c: F.col(f"_u{i}") for i, c in enumerate(choices)}


def _of(unions: dict[tuple[str, ...], Column], flags: Sequence[str], chosen: Sequence[str]) -> Column:
    return unions.get(tuple(f for f in flags if f in chosen), F.lit(0))


def overlap_counts(df: DataFrame, key: str, flags: Sequence[str]) -> DataFrame:
    """As :func:`indexday.operators.reshape.overlap_counts`, by inclusion and exclusion of unions of bitmaps."""
    wide, unions = _unions(df, key, flags)
    cells = []
    for chosen in unions:
        parts = [(-1) ** (k + 1) * _of(unions, flags, c) for k in range(1, len(chosen) + 1) for c in combinations(chosen, k)]
        cells.append(reduce(lambda a, b: a + b, parts).cast("long").alias(" & ".join(chosen)))
    wide = wide.select(*cells)
    return wide.unpivot([], wide.columns, "sets", "n")


def overlap_regions(df: DataFrame, key: str, flags: Sequence[str]) -> DataFrame:
    """As :func:`indexday.operators.reshape.overlap_regions`: ids in just these sets, from unions of bitmaps."""
    wide, unions = _unions(df, key, flags)
    whole = _of(unions, flags, flags)

    def within(sets: Sequence[str]) -> Column:
        """Ids in no set but these."""
        return whole - _of(unions, flags, [f for f in flags if f not in sets])

    cells = []
    for region in (r for r in product((1, 0), repeat=len(flags)) if any(r)):
        own = [f for f, bit in zip(flags, region) if bit]
        parts = [(-1) ** (len(own) - k) * within(c) for k in range(len(own) + 1) for c in combinations(own, k)]
        cells.append(reduce(lambda a, b: a + b, parts).cast("long").alias(" & ".join(own) + " only"))
    wide = wide.select(*cells)
    return wide.unpivot([], wide.columns, "region", "n")
