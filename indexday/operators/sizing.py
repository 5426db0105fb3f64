"""Broadcasts whose size has been checked."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

BROADCAST_BYTES = 32 * 1024 * 1024
# Columns with a row's identity do not compress further than this below their size in memory.
PLANNED_MARGIN = 32

_WIDTH = {T.BooleanType: 1, T.ByteType: 1, T.ShortType: 2, T.IntegerType: 4, T.DateType: 4, T.FloatType: 4}


def planned_bytes(df: DataFrame) -> int | None:
    """Spark's static size for a plan, or None where the session does not expose it.

    Taken before optimization: filters and semi joins count as large as their input and inner
    joins as the product of theirs. A projection of a scan counts by the widths of its types, which
    says too little where the columns left out compress better than those kept.
    """
    frame = getattr(df, "_jdf", None)
    if frame is None:
        return None
    return int(str(frame.queryExecution().analyzed().stats().sizeInBytes()))


def measured_bytes(df: DataFrame, limit: int) -> int | None:
    """Exact payload of a frame, or None when it is beyond ``limit``; reads no more than fits."""
    texts = [F.octet_length(f.name) for f in df.schema.fields if isinstance(f.dataType, T.StringType)]
    fixed = sum(_WIDTH.get(type(f.dataType), 8) for f in df.schema.fields)
    rows = limit // max(fixed, 1)
    text = sum((F.coalesce(t, F.lit(0)) for t in texts), F.lit(0))
    seen = df.limit(rows + 1).agg(F.count("*").alias("n"), F.coalesce(F.sum(text), F.lit(0)).alias("b")).first()
    size = seen.n * fixed + seen.b
    return None if seen.n > rows or size > limit else size


def is_small(df: DataFrame, limit: int = BROADCAST_BYTES, measure: bool = True) -> bool:
    """Whether a frame's payload fits, by a bounded count of its rows.

    The planned size only spares the count where it is far below the limit, or where a frame is
    planned as larger and ``measure`` does not allow the work.
    """
    planned = planned_bytes(df)
    if planned is not None and planned <= limit // PLANNED_MARGIN:
        return True
    if not measure and (planned is None or planned > limit):
        return False
    return measured_bytes(df, limit) is not None


def broadcast_if_small(df: DataFrame, limit: int = BROADCAST_BYTES, measure: bool = True) -> DataFrame:
    """Ask for a broadcast of ``df`` only once its size is known to fit.

    A bounded count decides, since a planned size may be wrong on either side: a code set is a
    few hundred rows out of a vocabulary of millions, which no static estimate sees, and without
    the hint the whole event table would be shuffled to meet it. A frame that
    does not fit is returned as it is and joins by shuffle, where AQE splits hot keys.
    """
    return F.broadcast(df) if is_small(df, limit, measure) else df
