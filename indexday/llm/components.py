"""Connected components of a graph given by its edges."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from indexday.sources import StageStore

MAX_ROUNDS = 100
# So many edges are 16 MB, which one task can finish.
LAST_EDGES = 1_000_000


def _finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The components of a bounded number of edges: labels hook onto smaller ones and are shortened."""
    columns = [(b.column("a").to_numpy(), b.column("b").to_numpy()) for b in batches]
    a, b = (np.concatenate([np.zeros(0, np.int64), *x]) for x in zip(*columns, strict=True)) if columns else (np.zeros(0, np.int64),) * 2
    ids, at = np.unique(np.concatenate([a, b]), return_inverse=True)
    a, b, label = at[: len(a)], at[len(a) :], np.arange(len(ids))
    while len(a):
        low, high = np.minimum(label[a], label[b]), np.maximum(label[a], label[b])
        open_ = low != high
        a, b = a[open_], b[open_]
        np.minimum.at(label, high[open_], low[open_])
        while (label[label] != label).any():
            label = label[label]
    yield pa.RecordBatch.from_arrays([pa.array(ids), pa.array(ids[label])], ["v", "p"])


def components(edges: DataFrame, store: StageStore, name: str = "components") -> DataFrame:
    """(id, component) for every vertex of (a, b) edges; ``component`` is the least id of its component.

    Each round joins every vertex to its neighbour of least priority, priorities being a hash that changes
    with the round, and contracts the edges; the number of vertices falls by a constant factor on average. All
    steps are aggregates with partial sums and joins, and each round is written. Once a count shows that a million
    edges are left at most, one task finishes them.
    """
    pairs = edges.filter("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
    left = store.put(f"{name}_edges_0", pairs)
    labels = store.put(
        f"{name}_labels_0",
        left.select(F.explode(F.array("a", "b")).alias("id")).distinct().withColumn("root", F.col("id")),
    )
    i, edges_left = 0, left.count()
    while edges_left:
        if i == MAX_ROUNDS:
            raise RuntimeError(f"components still open after {MAX_ROUNDS} rounds")
        i += 1
        if edges_left <= LAST_EDGES:
            parent = store.put(f"{name}_parents_{i}", left.coalesce(1).mapInArrow(_finish, "v long, p long"))
            labels = _moved(labels, parent)
            break
        rank = lambda c, i=i: F.struct(F.xxhash64(F.lit(i), c).alias("rank"), F.col(c).alias("v"))
        both = left.unionAll(left.select("b", "a"))
        lowest = both.groupBy("a").agg(F.min(rank("b")).alias("low"))
        parent = lowest.select(F.col("a").alias("v"), F.least("low", rank("a"))["v"].alias("p"))
        parent = store.put(f"{name}_parents_{i}", parent)
        moved = (
            left.join(parent.withColumnsRenamed({"v": "a", "p": "pa"}), "a")
            .join(parent.withColumnsRenamed({"v": "b", "p": "pb"}), "b")
            .filter("pa <> pb").select(F.least("pa", "pb").alias("a"), F.greatest("pa", "pb").alias("b")).distinct()
        )
        left = store.put(f"{name}_edges_{i}", moved)
        labels = store.put(f"{name}_labels_{i}", _moved(labels, parent))
        store.drop(f"{name}_edges_{i - 1}", f"{name}_labels_{i - 1}", f"{name}_parents_{i}")
        edges_left = left.count()
    least = labels.groupBy("root").agg(F.min("id").alias("component"))
    return labels.join(least, "root").select("id", "component")


def _moved(labels: DataFrame, parent: DataFrame) -> DataFrame:
    return labels.join(parent.withColumnRenamed("v", "root"), "root", "left").select("id", F.coalesce("p", "root").alias("root"))
