"""SQL text over named frames and tables."""

from __future__ import annotations

from collections.abc import Mapping
from typing import Any

from pyspark.sql import DataFrame, SparkSession


def run_sql(
    spark: SparkSession,
    text: str,
    frames: Mapping[str, DataFrame] | None = None,
    args: Mapping[str, Any] | None = None,
) -> DataFrame:
    """Run SQL text and keep the result distributed.

    ``{name}`` in the text stands for one of ``frames``; ``:name`` is a value from ``args``,
    and ``IDENTIFIER(:name)`` a table name from it.
    """
    return spark.sql(text, args=dict(args) if args else None, **(frames or {}))
