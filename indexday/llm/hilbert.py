"""Sharding along a Hilbert curve through several metadata dimensions."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from indexday.llm.common import free_name, local_row, part_of, parts, pieces, prepared, put_in_order
from indexday.sources import StageStore

QUANTILE_ACCURACY = 10_000


@dataclass(frozen=True)
class Curve:
    """The curve through a cube of 2**bits cells a side, as a walk over states (corner, axis).

    ``digit`` and ``then`` are indexed by state * corners + corner of the half-size cell: the cell's place
    on the curve within its parent, and the state inside it.
    """

    dimensions: int
    digit: tuple[int, ...]
    then: tuple[int, ...]

    @classmethod
    def of(cls, n: int) -> Curve:
        corners, digit, then = 1 << n, [], []

        def turn(x: int, by: int) -> int:
            by %= n
            return ((x << by) | (x >> (n - by))) & (corners - 1)

        def ones(x: int) -> int:
            count = 0
            while x & 1:
                x, count = x >> 1, count + 1
            return count

        def gray(x: int) -> int:
            return x ^ (x >> 1)

        place = {gray(i): i for i in range(corners)}
        for entry in range(corners):
            for axis in range(n):
                for corner in range(corners):
                    at = place[turn(corner ^ entry, -(axis + 1))]
                    first = 0 if at == 0 else gray(2 * ((at - 1) // 2))
                    along = 0 if at == 0 else ones(at - 1 if at % 2 == 0 else at) % n
                    digit.append(at)
                    then.append((entry ^ turn(first, axis + 1)) * n + (axis + along + 1) % n)
        return cls(n, tuple(digit), tuple(then))

    def index(self, cells: list[Column], bits: int) -> Column:
        """The curve index of a cell, one step per bit, from the coarsest to the finest."""
        n = self.dimensions
        digits = F.array(*[F.lit(x) for x in self.digit])
        states = F.array(*[F.lit(x) for x in self.then])

        def step(acc: Column, bit: Column) -> Column:
            corner = F.lit(0)
            for i, cell in enumerate(cells):
                corner = corner + F.call_function("shiftright", cell, bit).bitwiseAND(F.lit(1)) * F.lit(1 << i)
            return F.transform(
                F.array(acc["state"] * F.lit(1 << n) + corner),
                lambda at: F.struct(
                    F.get(states, at).alias("state"),
                    (acc["at"] * F.lit(1 << n) + F.get(digits, at)).cast("long").alias("at"),
                ),
            )[0]

        start = F.struct(F.lit(0).alias("state"), F.lit(0).cast("long").alias("at"))
        walk = F.sequence(F.lit(bits - 1), F.lit(0), F.lit(-1))
        return F.aggregate(walk, start, step, lambda acc: acc["at"])


def sort_key(df: DataFrame, name: str) -> Column:
    """A column as it is compared with its marks: whole texts as bytes, all else as a double."""
    kind = df.schema[name].dataType
    if isinstance(kind, (T.StringType, T.BinaryType)):
        return F.col(name).cast("binary")
    if isinstance(kind, (T.DateType, T.TimestampType)):
        return F.unix_micros(F.col(name).cast("timestamp")).cast("double")
    return F.col(name).cast("double")


def cells(df: DataFrame, dimensions: list[str], bits: int, store: StageStore) -> list[Column]:
    """Each dimension's cell, 0 to 2**bits - 1, between quantiles of all rows; nulls are in the first cell.

    Quantiles of numbers and dates come from one aggregate, those of texts from their counted distinct values.
    2**bits - 1 marks per dimension reach the driver, those of texts as whole values.
    """
    keys = [sort_key(df, d) for d in dimensions]
    texts = [i for i, d in enumerate(dimensions) if isinstance(df.schema[d].dataType, (T.StringType, T.BinaryType))]
    numbers = [i for i in range(len(keys)) if i not in texts]
    marks: dict[int, list] = {i: [] for i in range(len(keys))}
    if numbers:
        shares = [i / (1 << bits) for i in range(1, 1 << bits)]
        cuts = df.agg(*[F.percentile_approx(keys[i], shares, QUANTILE_ACCURACY).alias(f"c{i}") for i in numbers]).first()
        marks |= {i: sorted({float(x) for x in cuts[f"c{i}"] or []}) for i in numbers}
    if texts:
        each = F.explode(F.array(*[F.struct(F.lit(i).alias("dimension"), keys[i].alias("value")) for i in texts]))
        for r in text_marks(df.select(each.alias("at")).select("at.*"), bits, store).collect():
            marks[r["dimension"]].append(bytes(r["value"]))
    return [_above(sorted(marks[i]), key, bits) for i, key in enumerate(keys)]


def text_marks(values: DataFrame, bits: int, store: StageStore) -> DataFrame:
    """(dimension, value): the values at which i / 2**bits of a dimension's rows are reached, i from 1 to 2**bits - 1.

    Distinct values are counted, put in order and numbered by the rows up to them; nulls do not count.
    """
    counted = values.filter("value IS NOT NULL").groupBy("dimension", "value").agg(F.count("*").alias("times"))
    ordered = put_in_order(counted, [F.col("dimension"), F.col("value")], store, "values")
    totals = F.broadcast(ordered.groupBy("dimension").agg(F.sum("times").alias("total")))  # a row per dimension
    held = ordered.groupBy("dimension", part_of().alias("part")).agg(F.sum("times").alias("held"))
    earlier = Window.partitionBy("dimension").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    before = held.select("dimension", "part", F.coalesce(F.sum("held").over(earlier), F.lit(0)).alias("before"))
    inside = Window.partitionBy("dimension", "part").orderBy("row_at").rowsBetween(Window.unboundedPreceding, 0)
    up_to = ordered.withColumn("part", part_of()).withColumn("own", F.sum("times").over(inside))
    reached = F.expr(f"least((before + own) * {1 << bits} div total, {(1 << bits) - 1})")
    short = F.expr(f"least((before + own - times) * {1 << bits} div total, {(1 << bits) - 1})")
    return up_to.join(before, ["dimension", "part"]).join(totals, "dimension").filter(reached > short).select("dimension", "value")


def _above(marks: list, key: Column, bits: int) -> Column:
    """How many of the marks, in order, a key is above, by halving; none for null."""
    if not marks:
        return F.lit(0)
    listed = F.array(*[F.lit(m) for m in marks])

    def step(at: Column, width: Column) -> Column:
        return F.when(F.get(listed, at + width - 1) < key, at + width).otherwise(at)

    widths = F.array(*[F.lit(1 << b) for b in reversed(range(bits))])
    return F.when(key.isNull(), 0).otherwise(F.aggregate(widths, F.lit(0), step))


def shard(df: DataFrame, dimensions: list[str], ties: list[Column], shards: int, bits: int = 6) -> DataFrame:
    """``df`` with ``curve``, ``shard`` and ``slot``: rows in curve order, cut into runs of equal count.

    Rows are ordered by curve index, then ``ties``; shard sizes differ by one row at most, and a shard's slots
    count from 0. The ordered rows are written once, so that files and row groups hold neighbours on the
    curve and their statistics prune filters on any of the dimensions. A hot value is one cell of one
    dimension and is split by the others and by ``ties``.

    Nulls sort into the first cell. Rows equal in all of curve and ties keep an arbitrary order among
    themselves, fixed when written. An empty table has no shards. Columns named curve, shard or slot are
    replaced. Each dimension has 2**bits cells, at most as many as its quantiles differ.
    """
    spark = df.sparkSession
    store = prepared(spark)
    n = pieces(df)
    df = df.drop("curve", "shard", "slot")
    curve = Curve.of(len(dimensions))
    row = free_name(df, "row_at")
    indexed = df.withColumn("curve", curve.index(cells(df, dimensions, bits, store), bits))
    ordered = put_in_order(indexed, [F.col("curve"), *ties], store, "ordered", row, n)
    total = ordered.count()
    before = F.broadcast(parts(ordered, row).withColumnsRenamed({"part": "_part", "rows_before": "_before"}))
    rank = F.col("_before") + local_row(row)
    number = F.expr(f"cast(_rank * {shards} div {max(total, 1)} as int)")
    first = F.expr(f"(shard * cast({total} as long) + {shards - 1}) div {shards}")
    placed = ordered.join(before, part_of(row) == F.col("_part")).withColumn("_rank", rank)
    placed = placed.withColumn("shard", number).withColumn("slot", F.col("_rank") - first)
    return placed.drop("_rank", "_part", "_before", "n", row)


def write_shards(sharded: DataFrame, path: str) -> None:
    """One folder per shard; rows stay in the order of the curve."""
    sharded.write.partitionBy("shard").parquet(path)
