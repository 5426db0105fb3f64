"""What the operators of this package share: session settings, stages and row numbers."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from indexday.operators.sizing import planned_bytes
from indexday.session import tune
from indexday.sources import StageStore

BATCH_ROWS = 1024
BATCH_BYTES = 8 * 1024 * 1024
PIECE_BYTES = 64 * 1024 * 1024
UNKNOWN_BYTES = 1 << 55  # a plan without statistics counts as larger than anything


def prepared(spark: SparkSession) -> StageStore:
    """Settings for Python stages, and a store below the folder in ``spark.checkpoint.dir``.

    Batches are bounded in rows and bytes, so a worker holds a few documents however long they are.
    """
    tune(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", BATCH_ROWS)
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES)
    return StageStore(spark)


def give_back() -> None:
    """Return what this process has freed to the system, as far as the platform can."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):  # another C library
        pass


def lean(
    scan: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]],
) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """``scan``, whose worker gives its memory back when a task ends: workers live on, and the next stage shares the executor."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from scan(batches)
        finally:
            give_back()

    return run


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def free_name(df: DataFrame, name: str) -> str:
    """A column name that does not clash with those of ``df``, whatever their case."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = "_" + name
    return name


def pieces(source: DataFrame) -> int:
    """Partitions for the rows of a scan: the session's number, or more where that would make them large."""
    least = int(source.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    planned = planned_bytes(source) or 0
    return max(least, planned // PIECE_BYTES if planned < UNKNOWN_BYTES else 0)


def put_in_order(
    df: DataFrame, order: list[Column], store: StageStore, name: str, row: str = "row_at", n: int | None = None
) -> DataFrame:
    """Write ``df`` in the given order and return it with ``row``, its partition and place as one long.

    Ranges are cut from a sample of the keys, so hot prefixes are split as long as later keys differ.
    """
    n = n or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    placed = df.repartitionByRange(n, *order).sortWithinPartitions(*order)
    return store.put(name, placed.withColumn(row, F.monotonically_increasing_id()))


def parts(numbered: DataFrame, row: str = "row_at", **sums: Column) -> DataFrame:
    """One line per written partition: rows before it, and the sums before it; as many lines as tasks wrote."""
    part = F.shiftright(F.col(row), 33).alias("part")
    per = numbered.groupBy(part).agg(F.count("*").alias("n"), *[s.alias(k) for k, s in sums.items()])
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    return per.select(
        "part",
        F.coalesce(F.sum("n").over(before), F.lit(0)).alias("rows_before"),
        *[F.coalesce(F.sum(k).over(before), F.lit(0)).alias(f"{k}_before") for k in sums],
    )


def local_row(row: str = "row_at") -> Column:
    return F.col(row).bitwiseAND(F.lit((1 << 33) - 1))


def part_of(row: str = "row_at") -> Column:
    return F.shiftright(F.col(row), 33)
