"""Points in intervals through an index of time buckets."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from indexday.functions import in_interval
from indexday.operators.sizing import is_small

# Bucket widths in days. An interval goes by the least width that is not below its length, so it meets two buckets at
# most; the last width takes all dates there are.
WIDTHS = (64, 256, 1024, 4096, 16384, 1 << 22)
LEVEL, BUCKET = "_level", "_bucket"


def _bucket(day: Column, width: int | Column) -> Column:
    return F.floor(F.unix_date(day) / width).cast("int")


def indexed_intervals(spans: DataFrame, start: str | Column, end: str | Column) -> DataFrame:
    """A row per interval and bucket it meets (one or two); intervals that hold no day are left out."""
    lo, hi = (F.col(c) if isinstance(c, str) else c for c in (start, end))
    days = F.datediff(hi, lo) + 1
    level = F.lit(len(WIDTHS) - 1)
    for i in reversed(range(len(WIDTHS) - 1)):
        level = F.when(days <= WIDTHS[i], i).otherwise(level)
    width = F.element_at(F.array(*[F.lit(w) for w in WIDTHS]), F.col(LEVEL) + 1)
    sized = spans.filter(days >= 1).withColumn(LEVEL, level)
    return sized.withColumn(BUCKET, F.explode(F.array_distinct(F.array(_bucket(lo, width), _bucket(hi, width)))))


def indexed_points(points: DataFrame, point: str) -> DataFrame:
    """A row per point and bucket width."""
    places = F.array(
        *[F.struct(F.lit(i).alias(LEVEL), _bucket(F.col(point), w).alias(BUCKET)) for i, w in enumerate(WIDTHS)]
    )
    return points.select("*", F.inline(places)).filter(F.col(point).isNotNull())


def points_in_intervals(
    points: DataFrame,
    spans: DataFrame,
    *,
    key: str,
    point: str,
    start: str,
    end: str,
    keep: Sequence[str],
    first: Column | None = None,
    last: Column | None = None,
) -> DataFrame:
    """All columns of ``points`` and ``keep`` of ``spans`` for each interval of the same key that holds the point.

    Both ends belong to an interval; ``first`` and ``last`` replace them in the test, as for an interval that is
    shortened on both sides. A key's points meet only intervals in the same bucket of time and of like
    length, not all intervals of the key, and such a bucket is what a task gets: a key with very many intervals
    is spread. Each pair meets in one bucket, so no pair is found twice. Rows with a NULL end, point or key are in no pair.
    Points known to be small are broadcast.
    """
    lo = F.col(start) if first is None else first
    hi = F.col(end) if last is None else last
    shared = {c.lower() for c in points.columns} & {c.lower() for c in keep}
    if shared:
        raise ValueError(f"columns of both sides: {sorted(shared)}")
    right = spans.select(F.col(key).alias("_key"), lo.alias("_lo"), hi.alias("_hi"), *keep)
    right = indexed_intervals(right.filter(F.col("_key").isNotNull()), "_lo", "_hi")
    left = indexed_points(points, point)
    if is_small(points, measure=False):
        left = F.broadcast(left)
    same = (F.col(key) == F.col("_key")) & (F.col(f"l.{LEVEL}") == F.col(f"r.{LEVEL}")) & (F.col(f"l.{BUCKET}") == F.col(f"r.{BUCKET}"))
    met = left.alias("l").join(right.alias("r"), same & in_interval(point, "_lo", "_hi"))
    return met.select(*points.columns, *keep)
