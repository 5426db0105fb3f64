"""Exact order statistics of many variables and groups, by selecting ranks in sorted ranges."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from indexday.operators.sizing import broadcast_if_small
from indexday.sources import StageStore


def order_statistics(
    df: DataFrame,
    by: Sequence[str],
    values: Sequence[str],
    points: Sequence[float],
    names: Sequence[str],
    store: StageStore,
    stage: str = "ranked_values",
) -> DataFrame:
    """(by, variable, names): exact interpolated percentiles of each of ``values`` in each group, NULLs left out.

    All variables and groups are handled together. Equal values are counted, then dealt to sorted ranges by group, variable
    and value, which are written. The number of rows of each group in each range tells in which range a wanted
    rank lies, and only rows of those ranges are numbered, so no task sees more than a range. Variables are
    compared as doubles. A group without any value has no row.
    """
    keys = [*[f"_k{i}" for i in range(len(by))], "variable"]
    wide = df.select(*[F.col(b).alias(k) for b, k in zip(by, keys)], *[F.col(v).cast("double").alias(v) for v in values])
    long = wide.unpivot(keys[:-1], list(values), "variable", "_v").filter(F.col("_v").isNotNull())
    counted = long.groupBy(*keys, "_v").agg(F.count("*").alias("_freq"))
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    placed = counted.repartitionByRange(n, *keys, "_v").withColumn("_part", F.spark_partition_id())
    placed = store.put(stage, placed)

    per_part = placed.groupBy(*keys, "_part").agg(F.sum("_freq").alias("_here"))
    group = W.partitionBy(*keys)
    before = group.orderBy("_part").rowsBetween(W.unboundedPreceding, -1)
    ranges = per_part.select(
        *keys, "_part", "_here", F.coalesce(F.sum("_here").over(before), F.lit(0)).alias("_before"), F.sum("_here").over(group).alias("_n")
    )
    place = [F.lit(float(p)) * (F.col("_n") - 1) for p in points]
    ranks = F.array_distinct(F.flatten(F.array(*[F.array(F.floor(p), F.ceil(p)) for p in place])))
    inside = F.filter(ranks, lambda r: (r >= F.col("_before")) & (r < F.col("_before") + F.col("_here")))
    wanted = ranges.select(*keys, "_part", "_before", "_n", inside.alias("_ranks")).filter(F.size("_ranks") > 0)

    same = [F.col(f"l.{k}").eqNullSafe(F.col(f"r.{k}")) for k in (*keys, "_part")]
    near = placed.alias("l").join(broadcast_if_small(wanted).alias("r"), same).select("l.*", "_before", "_n", "_ranks")
    upto = W.partitionBy(*keys, "_part").orderBy("_v").rowsBetween(W.unboundedPreceding, 0)
    numbered = near.withColumn("_end", F.col("_before") + F.sum("_freq").over(upto))
    own = F.filter("_ranks", lambda r: (r >= F.col("_end") - F.col("_freq")) & (r < F.col("_end")))
    found = numbered.select(*keys, "_n", "_v", F.explode(own).alias("_rank"))
    at = F.map_from_entries(F.collect_list(F.struct("_rank", "_v")))
    picked = found.groupBy(*keys).agg(F.first("_n").alias("_n"), at.alias("_at"))

    def between(p: float) -> Column:
        x = F.lit(float(p)) * (F.col("_n") - 1)
        low, high = F.floor(x), F.ceil(x)
        a, b = F.col("_at")[low], F.col("_at")[high]
        return F.when(low == high, a).otherwise((high - x) * a + (x - low) * b)

    return picked.select(
        *[F.col(k).alias(b) for b, k in zip(by, keys)], "variable", *[between(p).alias(name) for p, name in zip(points, names)]
    )
