"""Reshaping, appending and set membership."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from itertools import combinations, product
from typing import Any

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from indexday.operators import bitmaps


def pivot_counts(df: DataFrame, rows: str, column: str, values: Sequence[Any], names: Sequence[str]) -> DataFrame:
    """Counts by two keys, one output column per listed value, 0 for an empty cell.

    Rows with a NULL in either key are left out. One conditional count per value keeps it a
    single aggregate.
    """
    cells = [F.count_if(F.col(column) == v).alias(n) for v, n in zip(values, names)]
    return df.filter(F.col(rows).isNotNull() & F.col(column).isNotNull()).groupBy(rows).agg(*cells)


def with_row_total(df: DataFrame, columns: Sequence[str], name: str = "total") -> DataFrame:
    return df.withColumn(name, reduce(lambda a, b: a + b, [F.col(c) for c in columns]))


def sort_by_row_total(df: DataFrame, columns: Sequence[str], key: str) -> DataFrame:
    """Rows with the largest total first; the total itself is dropped again."""
    return with_row_total(df, columns, "_total").orderBy(F.desc("_total"), key).drop("_total")


def to_long(df: DataFrame, ids: Sequence[str], values: Sequence[str], name: str, value: str) -> DataFrame:
    """One row per id and value column."""
    return df.unpivot(list(ids), list(values), name, value)


def append(*frames: DataFrame) -> DataFrame:
    """Rows of all frames; a column one of them lacks is NULL there."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def with_total(df: DataFrame, stratum: str, columns: Sequence[str], label: str = "Total") -> DataFrame:
    """Append a stratum that holds each distinct row over ``columns`` once."""
    return append(df, df.select(*columns).distinct().withColumn(stratum, F.lit(label)))


def as_text(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """The given columns as text, the rest as it is."""
    chosen = set(columns)
    return df.select(*[F.col(c).cast("string").alias(c) if c in chosen else F.col(c) for c in df.columns])


def _membership(df: DataFrame, key: str, flags: Sequence[str]) -> DataFrame:
    """Each id once, with 1 where any of its rows has the flag."""
    return df.groupBy(key).agg(*[F.coalesce(F.max(f), F.lit(0)).alias(f) for f in flags])


def set_sizes(df: DataFrame, flags: Sequence[str]) -> DataFrame:
    """Number of rows in each set; an id with several rows counts as often as it has rows."""
    wide = df.agg(*[F.count_if(F.col(f) == 1).alias(f) for f in flags])
    return wide.unpivot([], wide.columns, "sets", "n")


def overlap_counts(df: DataFrame, key: str, flags: Sequence[str], ids: DataFrame | None = None) -> DataFrame:
    """Number of distinct ids in each set and in each intersection of two or more sets.

    ``ids`` is a frame with all ids that is cheap to read, as a written stage. If they are dense whole numbers, the
    sets are bitmaps, and no row per id is shuffled.
    """
    if ids is not None and bitmaps.dense_ids(ids, key):
        return bitmaps.overlap_counts(df, key, flags)
    sets = [c for k in range(1, len(flags) + 1) for c in combinations(flags, k)]
    cells = [
        F.count_if(reduce(lambda a, b: a & b, [F.col(f) == 1 for f in chosen])).alias(" & ".join(chosen))
        for chosen in sets
    ]
    wide = _membership(df, key, flags).agg(*cells)
    return wide.unpivot([], wide.columns, "sets", "n")


def overlap_regions(df: DataFrame, key: str, flags: Sequence[str], ids: DataFrame | None = None) -> DataFrame:
    """Number of distinct ids in each region of the diagram; an empty region counts 0.

    ``ids`` is as in :func:`overlap_counts`.
    """
    if ids is not None and bitmaps.dense_ids(ids, key):
        return bitmaps.overlap_regions(df, key, flags)
    regions = [r for r in product((1, 0), repeat=len(flags)) if any(r)]
    cells = []
    for region in regions:
        inside = reduce(lambda a, b: a & b, [F.col(f) == bit for f, bit in zip(flags, region)])
        cells.append(F.count_if(inside).alias(" & ".join(f for f, bit in zip(flags, region) if bit) + " only"))
    wide = _membership(df, key, flags).agg(*cells)
    return wide.unpivot([], wide.columns, "region", "n")
