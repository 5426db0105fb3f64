"""Near duplicates among embeddings through a neighbour graph refined by NN-descent."""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from indexday.llm.common import part_of, prepared, put_in_order
from indexday.llm.components import components
from indexday.operators.sizing import broadcast_if_small
from indexday.sources import StageStore

ORDERS = 4
SIGNS = 12
LEAF = 256
NEIGHBOURS = 10
SAMPLED = 16
DESCENTS = 2
ROUNDS = 16
QUIET = 2
AUDITED = 512
RECALL = 0.98
BLOCK = 2048
SLACK = 1e-9


@dataclass(frozen=True)
class Duplicates:
    """``links``: one row per vector (vec_id, n_links, component_id, kept). ``recall``: share of an audited vector's
    true links whose ends are in one component, as the mean over vectors with about as many links, the least of these."""

    links: DataFrame
    recall: float


def _units(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Vectors to unit length in double precision; null, zero and non-finite ones get no unit."""
    for batch in batches:
        keys, units = [], []
        for vector in batch.column("vector").to_pylist():
            key = unit = None
            if vector and None not in vector:
                x = np.array(vector, np.float64)
                top = np.abs(x).max()
                if np.isfinite(top) and top > 0:
                    unit = x / top  # no square over- or underflows
                    unit = (unit / np.linalg.norm(unit)).tobytes()
                    key = xxhash.xxh3_128_digest(x.tobytes())
            keys.append(key)
            units.append(unit)
        yield pa.RecordBatch.from_arrays(
            [batch.column("vec_id"), pa.array(keys, pa.binary()), pa.array(units, pa.binary())], ["vec_id", "key", "unit"]
        )


def _matrix(column: pa.Array, kind=np.float64) -> np.ndarray:
    rows = [np.frombuffer(x.as_py(), np.float64) for x in column]
    wide = max(map(len, rows), default=0)
    out = np.zeros((len(rows), wide), kind)  # a shorter vector is zero in the components it lacks
    for i, r in enumerate(rows):
        out[i, : len(r)] = r
    return out


def _signatures(seed: int):
    """Places of each vector in some random orders: signs against hyperplanes, then the value along a direction. Those
    with ``few`` stand in as many further orders, which only they are in."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            everyone = _matrix(batch.column("unit"))
            wide = everyone.shape[1]
            few = np.flatnonzero(batch.column("few").to_numpy(zero_copy_only=False).astype(bool))
            columns: list[list] = [[], [], [], [], [], []]
            for order in range(2 * ORDERS):
                own = np.arange(len(everyone)) if order < ORDERS else few
                units, n = everyone[own], len(own)
                planes = np.stack([np.random.default_rng([seed, order, i]).standard_normal(SIGNS + 1) for i in range(wide)])
                values = units @ planes
                signs = (values[:, :SIGNS] > 0) @ (1 << np.arange(SIGNS))
                rest = [batch.column(c).take(pa.array(own)) for c in ("id", "component", "unit")]
                for c, x in zip(columns, (np.full(n, order), signs, values[:, SIGNS], *rest), strict=True):
                    c.append(x)
            types = [pa.int32(), pa.int64(), pa.float64()]
            arrays = [pa.array(np.concatenate(c), t) for c, t in zip(columns, types, strict=False)]
            yield pa.RecordBatch.from_arrays(
                [*arrays, *(pa.concat_arrays(c) for c in columns[3:])], ["order", "signs", "along", "id", "component", "unit"]
            )

    return scan


def _best(sims: np.ndarray, allowed: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, column, value) of the best allowed columns of each row."""
    sims = np.where(allowed, sims, -2)
    k = min(NEIGHBOURS, sims.shape[1])
    best = np.argpartition(-sims, k - 1, axis=1)[:, :k]
    row, col = np.repeat(np.arange(len(sims)), k), best.ravel()
    good = allowed[row, col]
    return row[good], col[good], sims[row[good], col[good]]


def _batch(found: list[tuple[np.ndarray, ...]], kinds=(np.int64, np.int64, np.float32, np.bool_)) -> pa.RecordBatch:
    columns = [np.concatenate([np.zeros(0, k), *(f[i] for f in found)]).astype(k) for i, k in enumerate(kinds)]
    return pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["id", "other", "sim", "across"][: len(kinds)])


def _leaves(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """First neighbours: the best, inside and outside the own component, among the vectors near in an order, leaf by
    leaf, leaves overlapping by half."""
    for batch in batches:
        orders, ids, units = batch.column("order").to_numpy(), batch.column("id").to_numpy(), _matrix(batch.column("unit"), np.float32)
        components_ = batch.column("component").to_numpy()
        found = []
        for order in np.unique(orders):
            own = np.flatnonzero(orders == order)
            for start in range(0, len(own), LEAF // 2):
                leaf = own[start : start + LEAF]
                if len(leaf) < 2:
                    continue
                sims = units[leaf] @ units[leaf].T
                apart = components_[leaf][:, None] != components_[leaf]
                for across, allowed in ((True, apart), (False, ~apart & ~np.eye(len(leaf), dtype=bool))):
                    row, col, sim = _best(sims, allowed)
                    found.append((ids[leaf[row]], ids[leaf[col]], sim, np.full(len(row), across)))
        yield _batch(found)


def _local_join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Neighbours of a hub meet each other: each member's best that beat its worst neighbour so far, inside and
    outside its component."""
    for batch in batches:
        found = []
        for members in batch.column("members"):
            rows = members.values
            ids, components_ = rows.field("id").to_numpy(), rows.field("component").to_numpy()
            if len(ids) < 2:
                continue
            units = _matrix(rows.field("unit"), np.float32)
            sims = units @ units.T
            apart = components_[:, None] != components_
            for across, allowed in ((True, apart), (False, ~apart & (ids[:, None] != ids))):
                worst = rows.field("outside" if across else "inside").to_numpy(zero_copy_only=False)
                row, col, sim = _best(sims, allowed & (sims > worst[:, None]))
                found.append((ids[row], ids[col], sim, np.full(len(row), across)))
        yield _batch(found)


PAIR = "id long, other long, sim float"
LISTED = f"{PAIR}, across boolean"


def _kept(pairs: DataFrame) -> DataFrame:
    """The best neighbours of each vector inside and outside its component."""
    best = Window.partitionBy("id", "across").orderBy(F.desc("sim"), "other")
    pairs = pairs.groupBy("id", "other", "across").agg(F.max("sim").alias("sim")).select("id", "other", "sim", "across")
    return pairs.withColumn("at", F.row_number().over(best)).filter(F.col("at") <= NEIGHBOURS).drop("at")


def _named_anew(graph: DataFrame, active: DataFrame) -> DataFrame:
    """The lists of a round by the components of the next."""
    own = active.select("id", "component")
    others = active.select(F.col("id").alias("other"), F.col("component").alias("other_component"))
    pairs = graph.select("id", "other", "sim").join(own, "id").join(others, "other")
    return pairs.select("id", "other", "sim", (F.col("component") != F.col("other_component")).alias("across"))


def _descend(graph: DataFrame, active: DataFrame) -> DataFrame:
    """One join of neighbours with neighbours' neighbours, by hub: its lists, and the best that list it."""
    back = Window.partitionBy("id", "across").orderBy(F.desc("sim"), "other")
    forward = graph.select("id", "other")
    reverse = graph.select(F.col("other").alias("id"), F.col("id").alias("other"), "sim", "across")
    reverse = reverse.withColumn("at", F.row_number().over(back)).filter(F.col("at") <= NEIGHBOURS).select("id", "other")
    worst = graph.groupBy("id", "across").agg(F.min("sim").alias("worst"), F.count("*").alias("n")).filter(F.col("n") >= NEIGHBOURS)
    worst = worst.groupBy("id").agg(
        F.max(F.when(~F.col("across"), F.col("worst"))).alias("inside"), F.max(F.when(F.col("across"), F.col("worst"))).alias("outside")
    )
    open_ = {c: F.coalesce(c, F.lit(-2.0)).cast("float") for c in ("inside", "outside")}
    known = active.select("id", "component", "unit").join(worst, "id", "left").withColumns(open_)
    seats = forward.unionAll(reverse).unionAll(active.select("id", F.col("id").alias("other"))).distinct()
    seats = seats.select(F.col("id").alias("hub"), F.col("other").alias("id"))
    member = F.struct("id", "component", "unit", "inside", "outside")
    hubs = seats.join(known, "id").groupBy("hub").agg(F.collect_list(member).alias("members"))
    return hubs.select("members").mapInArrow(_local_join, LISTED)


def _audit(sample: pa.Table, threshold: float):
    """True links of some vectors, against all."""
    ids, units = sample.column("id").to_numpy(), _matrix(sample.column("unit").combine_chunks())

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own, others = batch.column("id").to_numpy(), _matrix(batch.column("unit"))
            row, col = np.nonzero(others @ units.T >= threshold)
            there = own[row] != ids[col]
            yield _batch([(ids[col[there]], own[row[there]], np.ones(int(there.sum())))], (np.int64, np.int64, np.float32))

    return scan


def _exact(threshold: float):
    """Pairs of a frame (id, other, unit, unit_b) whose cosine reaches the threshold in double precision."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            a, b = _matrix(batch.column("unit")), _matrix(batch.column("unit_b"))
            wide = min(a.shape[1], b.shape[1]) if len(a) else 0
            good = np.einsum("ij,ij->i", a[:, :wide], b[:, :wide]) >= threshold
            yield pa.RecordBatch.from_arrays([batch.column(c).filter(pa.array(good)) for c in ("id", "other")], ["a", "b"])

    return scan


def _angles(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        a, b = _matrix(batch.column("unit")), _matrix(batch.column("pivot"))
        wide = min(a.shape[1], b.shape[1]) if len(a) else 0
        cosines = np.clip(np.einsum("ij,ij->i", a[:, :wide], b[:, :wide]), -1, 1)
        yield pa.RecordBatch.from_arrays(
            [batch.column("component"), batch.column("id"), batch.column("copies"), batch.column("unit"), pa.array(np.arccos(cosines))],
            ["component", "id", "copies", "unit", "angle"],
        )


def _block_links(threshold: float):
    """Links of two blocks of a component: counts for the outer vectors of the left block, and for the inner
    vectors of the right block their outer ones."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, counts = [], []
            for left, right in zip(batch.column("left"), batch.column("right"), strict=True):
                a, b = left.values, right.values
                x, y = _matrix(a.field("unit")), _matrix(b.field("unit"))
                own, others = a.field("id").to_numpy(), b.field("id").to_numpy()
                linked = (x @ y.T >= threshold) & (own[:, None] != others)
                inner = b.field("inner").to_numpy(zero_copy_only=False).astype(bool)
                ids += [own, others[inner]]
                counts += [linked @ b.field("copies").to_numpy(), a.field("copies").to_numpy() @ linked[:, inner]]
            arrays = [np.concatenate([np.zeros(0, np.int64), *x]).astype(np.int64) for x in (ids, counts)]
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in arrays], ["id", "n"])

    return scan


def near_duplicates(
    df: DataFrame, threshold: float = 0.95, id_col: str = "vec_id", vector_col: str = "embedding", seed: int = 8
) -> Duplicates:
    """Link vectors whose cosine in double precision reaches ``threshold``.

    Equal vectors are one. The first neighbours of a vector are the best among those near it in a few random
    orders (signs against hyperplanes); then neighbours of a hub are joined with each other, and who finds
    better ones than before replaces its worst. Listed pairs at or above the threshold are checked in double
    precision and kept as edges. In the next round, with new orders, every vector has a list of its best neighbours
    inside its component, through which others are reached, and one of its best outside, so a list full of links
    hides none: they join its component and leave the list. In further orders a component stands with about 16
    vectors, so that large ones do not fill the leaves. The rounds end when two on end join no components and the
    audit is met: 512 vectors chosen by a hash of their id are compared with all. Of each vector's
    true links the share within components is taken; its mean must be 0.98 among the vectors with one link, with two
    or three, with four to seven and so on, so large families do not stand for small ones. If that is not reached
    in 16 rounds, an error is raised.

    ``n_links`` is exact within components: vectors within half the threshold's angle of their component's first
    vector link with each other for sure and are counted by arithmetic, so a large group of near copies is
    never expanded; the others are compared with all of their component, block by block.

    Null vectors, zero vectors and those with null or non-finite components link with nothing and are their own
    component; a null id has neither component nor ``kept``. Repeated rows count as vectors of their own. A
    shorter vector is zero in the components it lacks. An empty table gives no rows.
    """
    spark = df.sparkSession
    store = prepared(spark)
    rows = df.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).alias("vector"))
    rows = store.put("rows", rows.mapInArrow(_units, "vec_id long, key binary, unit binary"))
    usable = rows.filter("vec_id IS NOT NULL AND key IS NOT NULL")
    units = usable.groupBy("key").agg(F.min("vec_id").alias("id"), F.count("*").alias("copies"), F.first("unit").alias("unit"))
    # Two different vectors may share an id: the pair (id, key) is numbered anew.
    units = store.put("units", units.withColumn("vec", F.col("id")).withColumn("id", F.monotonically_increasing_id()))
    links, recall = _search(units, threshold, seed, store)
    named = store.put("components", units.select("id").join(links, "id", "left").select("id", F.coalesce("component", "id").alias("component")))
    counted = _count_links(units.join(named, "id"), threshold, store)
    least = units.join(named, "id").groupBy("component").agg(F.min("vec").alias("least"))
    known = units.select("id", "key").join(named, "id").join(least, "component").join(counted, "id", "left")
    known = store.put("known", known.select("key", "least", F.coalesce("n", F.lit(0)).cast("long").alias("n")))
    out = rows.select("vec_id", F.when(F.col("vec_id").isNotNull(), F.col("key")).alias("key")).join(known, "key", "left").select(
        "vec_id", F.coalesce("n", F.lit(0).cast("long")).alias("n_links"), F.coalesce("least", "vec_id").alias("component_id")
    )
    return Duplicates(out.withColumn("kept", F.col("vec_id") == F.col("component_id")), recall)


def _search(units: DataFrame, threshold: float, seed: int, store: StageStore) -> tuple[DataFrame, float]:
    """(id, component) of linked vectors, and the audited recall."""
    spark = units.sparkSession
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    sample = units.orderBy(F.xxhash64(F.lit(seed), "id")).limit(AUDITED).select("id", "unit").toArrow()
    if not sample.num_rows:
        return spark.createDataFrame([], "id long, component long"), 1.0
    truth = store.put("truth", units.select("id", "unit").mapInArrow(_audit(sample, threshold), PAIR))
    vectors = units.select("id", "unit")
    active, graph = vectors.select("id", F.col("id").alias("component"), "unit", F.lit(False).alias("few")), None
    edges, labels, quiet = None, None, 0
    low = threshold - 1e-5  # similarities of the lists are in single precision
    for i in range(ROUNDS):
        placed = active.mapInArrow(
            _signatures(seed + i), "order int, signs long, along double, id long, component long, unit binary"
        )
        placed = placed.repartitionByRange(n, "order", "signs", "along").sortWithinPartitions("order", "signs", "along")
        near = placed.mapInArrow(_leaves, LISTED)
        graph = store.put(f"graph_{i}", _kept(near if graph is None else near.unionAll(_named_anew(graph, active))))
        for d in range(DESCENTS):
            graph = store.put(f"graph_{i}_{d}", _kept(graph.unionAll(_descend(graph, active))))
        near = graph.filter(F.col("across") & (F.col("sim") >= low))
        near = near.select(F.least("id", "other").alias("id"), F.greatest("id", "other").alias("other")).distinct()
        both = near.join(vectors, "id").join(units.select(F.col("id").alias("other"), F.col("unit").alias("unit_b")), "other")
        new = store.put(f"edges_{i}", both.select("id", "other", "unit", "unit_b").mapInArrow(_exact(threshold), "a long, b long"))
        grown = not new.isEmpty()
        if grown or labels is None:
            edges = new if edges is None else edges.unionAll(new)
            labels = store.put(f"labels_{i}", components(edges, store, f"linked_{i}"))
        quiet = 0 if grown else quiet + 1
        if quiet >= QUIET:
            recall = _recall(truth, labels)
            if recall >= RECALL:
                return labels, recall
        active = store.put(f"active_{i}", _active(vectors, labels, seed + i))
    raise RuntimeError(f"links still open after {ROUNDS} rounds (recall {_recall(truth, labels):.4f}, wanted {RECALL})")


def _active(vectors: DataFrame, labels: DataFrame, seed: int) -> DataFrame:
    """(id, component, unit, few): ``few`` marks the first vector of each component and about 16 others."""
    sizes = labels.groupBy("component").agg(F.count("*").alias("m"))
    drawn = F.pmod(F.xxhash64(F.lit(seed), "id"), F.col("m")) < SAMPLED
    named = labels.join(broadcast_if_small(sizes), "component").select("id", "component", (drawn | (F.col("id") == F.col("component"))).alias("few"))
    return vectors.join(named, "id", "left").select(
        "id", F.coalesce("component", "id").alias("component"), "unit", F.coalesce("few", F.lit(True)).alias("few")
    )


def _recall(truth: DataFrame, labels: DataFrame) -> float:
    """Least mean share of a vector's true links within components, over the classes of vectors with 2^k links or more."""
    a = labels.withColumnRenamed("component", "ca")
    b = labels.select(F.col("id").alias("other"), F.col("component").alias("cb"))
    joined = truth.join(a, "id", "left").join(b, "other", "left")
    each = joined.groupBy("id").agg(F.count("*").alias("n"), F.count(F.when(F.col("ca") == F.col("cb"), 1)).alias("found"))
    by_size = each.groupBy(F.length(F.bin("n")).alias("size")).agg(F.avg(F.col("found") / F.col("n")).alias("recall"))
    least = by_size.agg(F.min("recall")).first()[0]
    return 1.0 if least is None else least


def _count_links(members: DataFrame, threshold: float, store: StageStore) -> DataFrame:
    """(id, n): links of each distinct vector, copies counted."""
    pivots = members.filter(F.col("id") == F.col("component")).select("component", F.col("unit").alias("pivot"))
    several = members.groupBy("component").agg(F.count("*").alias("m")).filter("m > 1").select("component")
    inside = members.join(several, "component").join(pivots, "component").select("component", "id", "copies", "unit", "pivot")
    inside = inside.mapInArrow(_angles, "component long, id long, copies long, unit binary, angle double")
    half = math.acos(threshold) / 2 - SLACK
    placed = put_in_order(inside.withColumn("inner", F.col("angle") <= half), [F.col("component"), F.col("inner"), F.col("id")], store, "angles")

    core = placed.filter("inner").groupBy("component").agg(F.sum("copies").alias("core"))
    sure = placed.filter("inner").join(broadcast_if_small(core), "component").select("id", (F.col("core") - F.col("copies")).alias("n"))
    own = members.select("id", (F.col("copies") - 1).alias("n"))

    # Components with outer vectors are cut into blocks; those with outer ones meet all.
    outer = placed.filter("NOT inner").select("component").distinct()
    open_ = placed.join(broadcast_if_small(outer), "component", "left_semi")
    in_part = Window.partitionBy("component", part_of()).orderBy("row_at")
    block = F.struct(part_of().alias("part"), F.expr(f"(at - 1) div {BLOCK}").alias("no"))
    blocks = open_.withColumn("at", F.row_number().over(in_part)).withColumn("block", block)
    blocks = blocks.groupBy("component", "block").agg(
        F.collect_list(F.struct("id", "copies", "unit", "inner")).alias("right"), F.min("inner").alias("all_inner")
    )
    blocks = store.put("blocks", blocks)
    left = blocks.filter("NOT all_inner").select(
        "component", F.filter("right", lambda x: ~x["inner"]).alias("left")
    )
    met = left.join(blocks.select("component", "right"), "component")
    rest = met.select("left", "right").mapInArrow(_block_links(threshold), "id long, n long")
    return own.unionAll(sure).unionAll(rest).groupBy("id").agg(F.sum("n").alias("n"))
