"""Near duplicates by a Jaccard join on word n-grams, searched as T-occurrence problems with DivideSkip."""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from indexday.llm.common import lean, part_of, prepared, put_in_order
from indexday.llm.components import components
from indexday.operators.sizing import broadcast_if_small

WORDS = 5
SEGMENT = 1 << 20
ID_BITS = 53
SLICE_POSTINGS = 1_000_000
MIN_SLICES = 32
DF_TOP = 65_535
HELD_POSTINGS = 3_000_000
BLOCK_WEIGHT = 400_000
DOC_WEIGHT = 400
MU = 0.0085  # DivideSkip's constant for the share of long lists
HEAP_TOTAL = 512

_U = np.uint64
_R = 0x9E3779B97F4A7C15
_R_INVERSE = pow(_R, -1, 1 << 64)
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_BYTE = np.random.default_rng(10).integers(1, 1 << 63, 256, dtype=np.uint64)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


class _Powers:
    """Powers of the base and of its inverse, as many as the longest segment needs."""

    def __init__(self):
        self.up = self.down = np.ones(1, np.uint64)

    def to(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            self.up, self.down = (
                np.multiply.accumulate(np.r_[_U(1), np.full(n - 1, base, np.uint64)]) for base in (_R, _R_INVERSE)
            )
        return self.up, self.down


_POWERS = _Powers()


def _word_hashes(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(start, hash) of every word of the bytes; a hash does not depend on the word's place."""
    space = _SPACE[data]
    edges = np.flatnonzero(np.diff(np.r_[True, space, True].astype(np.int8)))
    starts, ends = edges[::2], edges[1::2]
    up, down = _POWERS.to(len(data) + 1)
    sums = np.r_[_U(0), np.cumsum(_BYTE[data] * up[: len(data)])]
    return starts, _mix((sums[ends] - sums[starts]) * down[starts])


def shingle_sets(texts: list[str | None]) -> list[np.ndarray]:
    """For each text the sorted ids (53-bit hashes) of its distinct n-grams of words.

    Words stand between ASCII white space, A-Z count as a-z. Fewer words than an n-gram's are one n-gram;
    without words the set is empty.
    """
    raw = [(t or "").encode().lower() for t in texts]
    data = np.frombuffer(b"\n".join(raw) + b"\n", np.uint8)
    begins = np.cumsum([0, *[len(r) + 1 for r in raw]])
    starts, hashes, at = [], [], 0
    while at < len(data):
        end = min(at + SEGMENT, len(data))
        while end < len(data) and not _SPACE[data[end - 1]]:
            end += 1
        s, h = _word_hashes(data[at:end])
        starts.append(s + at)
        hashes.append(h)
        at = end
    words = np.concatenate(hashes)
    first = np.searchsorted(np.concatenate(starts), begins)
    out = []
    runs = np.zeros(0, np.uint64)
    if len(words) >= WORDS:
        n = len(words) - WORDS + 1
        runs = words[:n].copy()
        for j in range(1, WORDS):
            runs = _mix(runs * _U(_R) + words[j : n + j])
    for a, b in zip(first[:-1], first[1:], strict=True):
        if b - a >= WORDS:
            own = runs[a : b - WORDS + 1]
        elif b > a:
            one = words[a : a + 1].copy()
            for j in range(a + 1, b):
                one = _mix(one * _U(_R) + words[j : j + 1])
            own = _mix(one + _U(b - a))
        else:
            own = words[:0]
        out.append(np.unique(own >> _U(64 - ID_BITS)))
    return out


def _key(ids: np.ndarray) -> int:
    return xxhash.xxh3_64_intdigest(ids.tobytes()) - (1 << 63)


def _classes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        sets = shingle_sets(batch.column("text").to_pylist())
        keys = [_key(s) if len(s) else None for s in sets]
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), pa.array([len(s) for s in sets], pa.int64()), pa.array(keys, pa.int64())],
            ["doc_id", "n_shingles", "key"],
        )


def _postings(slices: int):
    """Each batch's n-grams, dealt into slices of the id space: keys, numbers of ids per key, ids within the slice."""
    width = -(-(1 << ID_BITS) // slices)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = {_key(s): s for s in shingle_sets(batch.column("text").to_pylist()) if len(s)}
            if not sets:
                continue
            keys = np.array(list(sets), np.int64)
            sizes = [len(s) for s in sets.values()]
            ids = np.concatenate(list(sets.values())).astype(np.int64)
            owner = np.repeat(np.arange(len(keys)), sizes)
            at = ids // width
            order = np.argsort(at, kind="stable")
            ids, owner, at = ids[order] - at[order] * width, owner[order], at[order]
            names, begins = np.unique(at, return_index=True)
            rows = []
            for a, b in zip(begins, np.append(begins[1:], len(at)), strict=True):
                who, counts = np.unique(owner[a:b], return_counts=True)
                low = ids[a:b].astype("<u8").view(np.uint8).reshape(-1, 8)[:, :6]
                rows.append((keys[who].tobytes(), counts.astype("<u4").tobytes(), np.ascontiguousarray(low).tobytes()))
            yield pa.RecordBatch.from_arrays(
                [pa.array(names, pa.int32()), *[pa.array([r[i] for r in rows], pa.binary()) for i in range(3)]],
                ["slice", "keys", "counts", "ids"],
            )

    return scan


def _frequent(slices: int, buckets: int):
    """The n-grams of a slice that stand in two texts at least, sent back to the texts with their frequency.

    Beyond the top frequency counts are all alike, so what is known to be there is sent on without being held.
    """
    width = -(-(1 << ID_BITS) // slices)

    def send(keys: np.ndarray, ids: np.ndarray, df: np.ndarray) -> pa.RecordBatch:
        at = keys % buckets
        order = np.argsort(at, kind="stable")
        keys, ids, df, at = keys[order], ids[order], df[order], at[order]
        names, begins = np.unique(at, return_index=True)
        cuts = list(zip(begins, np.append(begins[1:], len(at)), strict=True))
        columns = [[x[a:b].tobytes() for a, b in cuts] for x in (keys, ids, df.astype("<u2"))]
        return pa.RecordBatch.from_arrays(
            [pa.array(names, pa.int32()), *[pa.array(c, pa.binary()) for c in columns]], ["bucket", "keys", "ids", "df"]
        )

    def distinct(ids: np.ndarray, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        order = np.argsort(ids, kind="stable")
        ids, keys = ids[order], keys[order]
        shared = np.r_[False, ids[1:] == ids[:-1]]
        shared[:-1] |= shared[1:]
        at = np.flatnonzero(shared)
        again = at[np.lexsort((keys[at], ids[at]))]
        ids[at], keys[at] = ids[again], keys[again]
        new = np.r_[True, (ids[1:] != ids[:-1]) | (keys[1:] != keys[:-1])] if len(ids) else np.zeros(0, bool)
        return ids[new], keys[new]

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # Rows come slice by slice, and what one slice holds is gone before the next.
        at, held, size, room, top = None, [], 0, HELD_POSTINGS, np.zeros(0, np.int64)

        def ended():
            if not held:
                return
            ids, own = distinct(*(np.concatenate(x) for x in zip(*held, strict=True)))
            held.clear()
            starts = np.flatnonzero(np.r_[True, ids[1:] != ids[:-1]]) if len(ids) else np.zeros(0, int)
            df = np.diff(np.append(starts, len(ids)))
            df = np.repeat(df, df)
            there = df > 1
            if there.any():
                yield send(own[there], ids[there] + at * width, np.minimum(df[there], DF_TOP))

        for batch in batches:
            for s, keys, counts, low in zip(*[batch.column(c).to_pylist() for c in ("slice", "keys", "counts", "ids")], strict=True):
                if s != at:
                    yield from ended()
                    at, held, size, room, top = s, [], 0, HELD_POSTINGS, np.zeros(0, np.int64)
                wide = np.zeros((len(low) // 6, 8), np.uint8)
                wide[:, :6] = np.frombuffer(low, np.uint8).reshape(-1, 6)
                ids = wide.view("<u8").ravel().astype(np.int64)
                own = np.repeat(np.frombuffer(keys, np.int64), np.frombuffer(counts, "<u4"))
                if len(top):
                    known = np.isin(ids, top)
                    if known.any():
                        yield send(own[known], ids[known] + s * width, np.full(known.sum(), DF_TOP))
                        ids, own = ids[~known], own[~known]
                held.append((ids, own))
                size += len(ids)
                if size > room:
                    ids, own = distinct(*(np.concatenate(x) for x in zip(*held, strict=True)))
                    names, times = np.unique(ids, return_counts=True)
                    often = names[times >= DF_TOP]
                    if len(often):
                        top = np.union1d(top, often)
                        known = np.isin(ids, often)
                        yield send(own[known], ids[known] + s * width, np.full(known.sum(), DF_TOP))
                        ids, own = ids[~known], own[~known]
                    held, size = [(ids, own)], len(ids)
                    room = max(HELD_POSTINGS, 2 * size)  # so that packing again and again costs no more than sorting once
        yield from ended()

    return scan


def _prefixes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The rarest n - T + 1 n-grams of each text, of which a partner shares one at least; those of one text only are left out."""
    sizes, found = [], []
    for batch in batches:
        for keys, ids, df in zip(*[batch.column(c).to_pylist() for c in ("keys", "ids", "df")], strict=True):
            if df is None:
                sizes.append((np.frombuffer(keys, np.int64), np.frombuffer(ids, np.int64)))
            else:
                found.append((np.frombuffer(keys, np.int64), np.frombuffer(ids, np.int64), np.frombuffer(df, "<u2")))
    if not found:
        return
    names, n = (np.concatenate(x) for x in zip(*sizes, strict=True))
    by_name = np.argsort(names, kind="stable")
    names, n = names[by_name], n[by_name]
    keys, ids, df = (np.concatenate(x) for x in zip(*found, strict=True))
    order = np.lexsort((ids, df, keys))
    keys, ids, df = keys[order], ids[order], df[order]
    new = np.r_[True, (keys[1:] != keys[:-1]) | (ids[1:] != ids[:-1])]  # sent twice when known to be on top
    keys, ids, df = keys[new], ids[new], df[new]
    starts = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]])
    counts = np.diff(np.append(starts, len(keys)))
    own = n[np.searchsorted(names, keys[starts])]
    prefix = own - (3 * own + 3) // 4 + 1 - (own - counts)
    place = np.arange(len(keys)) - np.repeat(starts, counts)
    keep = place < np.repeat(prefix, counts)
    for a in range(0, int(keep.sum()), 1 << 16):
        part = np.flatnonzero(keep)[a : a + (1 << 16)]
        yield pa.RecordBatch.from_arrays([pa.array(ids[part], pa.int64()), pa.array(keys[part], pa.int64())], ["id", "key"])


def _sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = list(zip(batch.column("group").to_pylist(), batch.column("key").to_pylist(), strict=True))
        sets = shingle_sets(batch.column("text").to_pylist())
        kept = [(g, k, len(s), s.tobytes()) for (g, k), s in zip(rows, sets, strict=True) if len(s) and _key(s) == k]
        types = [pa.int64(), pa.int64(), pa.int64(), pa.binary()]
        yield pa.RecordBatch.from_arrays(
            [pa.array([r[i] for r in kept], t) for i, t in enumerate(types)], ["group", "key", "n", "ids"]
        )


class _Union:
    def __init__(self, n: int):
        self.parent = list(range(n))

    def root(self, x: int) -> int:
        while self.parent[x] != x:
            self.parent[x] = self.parent[self.parent[x]]
            x = self.parent[x]
        return x

    def join(self, x: int, y: int) -> bool:
        x, y = self.root(x), self.root(y)
        self.parent[max(x, y)] = min(x, y)
        return x != y


def _merge(lists: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """(entry, occurrences) over sorted lists: a heap for few entries, a merge sort of the runs for many."""
    if sum(map(len, lists)) <= HEAP_TOTAL:
        merged = np.fromiter(heapq.merge(*(x.tolist() for x in lists)), np.int64)
    else:
        merged = np.sort(np.concatenate(lists), kind="stable")
    new = np.flatnonzero(np.r_[True, merged[1:] != merged[:-1]]) if len(merged) else np.zeros(0, int)
    return merged[new], np.diff(np.append(new, len(merged)))


def divide_skip(sets: list[np.ndarray], side: np.ndarray | None = None) -> list[tuple[int, int]]:
    """Pairs with 100 * intersection >= 75 * union that span the components of all such pairs.

    ``sets`` come with growing sizes. Each is a query for the smaller ones before it: the lists of its ids are
    divided, the short ones are merged and their entries counted, and an entry that can still reach the
    overlap T is looked up in the long ones by binary search. Sets already connected are not looked up.
    With ``side`` only pairs of different sides are compared.
    """
    sizes = np.array([len(s) for s in sets])
    ids = np.concatenate(sets)
    order = np.argsort(ids, kind="stable")
    owner = np.repeat(np.arange(len(sets)), sizes)[order]
    ids, number = np.unique(ids, return_inverse=True)
    begins = np.searchsorted(number[order], np.arange(len(ids) + 1))
    longest = int(np.diff(begins).max(initial=1))
    number = np.split(number, np.cumsum(sizes)[:-1])
    union, links = _Union(len(sets)), []
    for x in range(1, len(sets)):
        first = int(np.searchsorted(sizes, -(-3 * int(sizes[x]) // 4)))
        if first >= x:
            continue
        lists = []
        for i in number[x]:
            own = owner[begins[i] : begins[i + 1]]
            if len(own) > 1:
                a, b = np.searchsorted(own, (first, x))
                if b > a:
                    lists.append(own[a:b])
        least = (3 * int(sizes[x]) + 3) // 4
        if len(lists) < least:
            continue
        lists.sort(key=len)
        long = min(int(least / (MU * math.log2(longest + 1) + 1)), least - 1)
        split = len(lists) - long
        found, counts = _merge(lists[:split])
        if side is not None:
            other = side[found] != side[x]
            found, counts = found[other], counts[other]
        wanted = -(-3 * (sizes[found] + sizes[x]) // 7)
        root = union.root(x)
        open_ = (counts + long >= wanted) & np.array([union.root(int(y)) != root for y in found], bool)
        found, counts, wanted = found[open_], counts[open_], wanted[open_]
        for left, own in enumerate(reversed(lists[split:])):
            if not len(found):
                break
            at = np.searchsorted(own, found)
            counts = counts + (own[np.minimum(at, len(own) - 1)] == found)
            alive = counts + (long - 1 - left) >= wanted
            found, counts, wanted = found[alive], counts[alive], wanted[alive]
        links += [(x, int(y)) for y in found[counts >= wanted] if union.join(x, int(y))]
    return links


def _linked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by task and size to links; a task compares one block with itself, or two blocks with each other."""

    def search(rows: list[tuple]) -> pa.RecordBatch:
        rows.sort(key=lambda r: (len(r[3]), r[1]))
        sets = [np.frombuffer(r[3], np.uint64) for r in rows]
        (_, left, right), side = rows[0][0], np.array([r[2] for r in rows])
        found = divide_skip(sets, None if left == right else side) if len(rows) > 1 else []
        pairs = [(rows[x][1], rows[y][1]) for x, y in found]
        return pa.RecordBatch.from_arrays([pa.array([p[i] for p in pairs], pa.int64()) for i in (0, 1)], ["a", "b"])

    task, rows = None, []
    for batch in batches:
        columns = [batch.column(c).to_pylist() for c in ("group", "left", "right", "key", "block", "ids")]
        for group, left, right, key, block, ids in zip(*columns, strict=True):
            if (group, left, right) != task:
                if rows:
                    yield search(rows)
                task, rows = (group, left, right), []
            rows.append((task, key, block, ids))
    if rows:
        yield search(rows)


def near_duplicates(docs: DataFrame) -> DataFrame:
    """(doc_id, n_shingles, component_id): classes of documents connected by a Jaccard similarity of 0.75 or more.

    Texts with equal sets are one key. All n-grams are dealt by hash into slices, which count the texts each
    stands in; those of two or more return to their texts. By rarity, T = ceil(0.75 n) common n-grams leave
    n - T + 1 of which a partner shares one, and texts sharing one of these are in one candidate group. A
    group's sets, in order of size, are cut into blocks of bounded weight; a task searches one block, or what two
    blocks share (:func:`divide_skip`), and returns links that span what it found, so large groups of near copies
    yield as many links as texts, not as pairs. Of two blocks only texts meet that have a rare n-gram and a size
    in common with the other, so texts pieced together from each other's passages are compared with their neighbours.

    Null texts and texts without words have an empty set and are linked with nothing, as are rows without
    doc_id, whose component is null. Repeated rows and ids give a row each. Other columns are not read. An
    empty table gives no rows. n-grams are compared by 53-bit hashes, sets by 64-bit hashes.
    """
    named, labelled = _labelled(docs)
    own = F.when(F.col("doc_id").isNotNull(), F.coalesce("least.first", "doc_id"))
    return named.join(labelled, "key", "left").select("doc_id", "n_shingles", own.alias("component_id"))


def representatives(docs: DataFrame) -> DataFrame:
    """(doc_id, key, kept) for each row: whether it stands for its class, by doc_id and the key of its set.

    Of a class the row of least doc_id, then key, is kept, and with it rows of the same doc_id and set. Rows
    without doc_id or words are in no class and kept, whatever else has their doc_id.
    """
    named, labelled = _labelled(docs)
    chosen = (F.col("least.first") == F.col("doc_id")) & (F.col("least.key") == F.col("key"))
    return named.join(labelled, "key", "left").select("doc_id", "key", F.coalesce(chosen, F.lit(True)).alias("kept"))


def keyed(docs: DataFrame, column: str) -> DataFrame:
    """``docs`` with the key of each text's set, null without words."""
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema.fields)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = [_key(s) if len(s) else None for s in shingle_sets(batch.column("text").to_pylist())]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(keys, pa.int64())], [*batch.schema.names, column])

    prepared(docs.sparkSession)
    return docs.mapInArrow(lean(scan), f"{kinds}, `{column}` long")


def _labelled(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(doc_id, n_shingles, key) of every row; (key, least): the least (first, key) of the key's class, first its least doc_id."""
    spark = docs.sparkSession
    store = prepared(spark)
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    named = store.put("classes", docs.mapInArrow(lean(_classes), "doc_id long, n_shingles long, key long"))
    known = named.filter("doc_id IS NOT NULL AND key IS NOT NULL")
    keys = store.put("keys", known.groupBy("key").agg(F.min("doc_id").alias("first"), F.max("n_shingles").alias("n")))
    candidates, rare = _candidates(docs.filter("doc_id IS NOT NULL"), keys, store)
    links = store.put("links", _links(docs, keys, candidates, rare, store))
    linked = components(links, store, "linked").withColumnsRenamed({"id": "key", "component": "root"})
    labelled = keys.join(linked, "key", "left").withColumn("root", F.coalesce("root", "key"))
    labelled = store.put("labelled", labelled.select("key", "root", "first"))
    least = labelled.groupBy("root").agg(F.min(F.struct("first", "key")).alias("least"))
    return named, labelled.join(least, "root").select("key", "least")


def _candidates(docs: DataFrame, keys: DataFrame, store) -> tuple[DataFrame, DataFrame]:
    """(key, group): the components of texts that share a rare n-gram; (id, key): each text's rare n-grams."""
    total = keys.agg(F.sum("n")).first()[0] or 0
    slices = max(MIN_SLICES, -(-total // SLICE_POSTINGS))
    dealt = docs.select("text").mapInArrow(lean(_postings(slices)), "slice int, keys binary, counts binary, ids binary")
    found = dealt.repartition(slices, "slice").sortWithinPartitions("slice").mapInArrow(
        lean(_frequent(slices, slices)), "bucket int, keys binary, ids binary, df binary"
    )
    sizes = keys.select("key", "n").mapInArrow(_packed_sizes(slices), "bucket int, keys binary, ids binary, df binary")
    rare = found.unionAll(sizes).repartition(slices, "bucket").mapInArrow(lean(_prefixes), "id long, key long")
    rare = store.put("rare", rare)
    least = rare.groupBy("id").agg(F.min("key").alias("b"), F.count("*").alias("df")).filter("df > 1")
    edges = rare.join(least, "id").select(F.col("key").alias("a"), "b").filter("a <> b").distinct()
    grouped = components(edges, store, "candidates").withColumnsRenamed({"id": "key", "component": "group"})
    return store.put("candidates", grouped), rare


def _packed_sizes(buckets: int):
    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, n = batch.column("key").to_numpy(), batch.column("n").to_numpy()
            at = keys % buckets
            names = np.unique(at)
            columns = [[x[at == b].tobytes() for b in names] for x in (keys, n)]
            yield pa.RecordBatch.from_arrays(
                [pa.array(names, pa.int32()), *[pa.array(c, pa.binary()) for c in columns], pa.nulls(len(names), pa.binary())],
                ["bucket", "keys", "ids", "df"],
            )

    return scan


def _links(docs: DataFrame, keys: DataFrame, candidates: DataFrame, rare: DataFrame, store) -> DataFrame:
    wanted = candidates.join(keys, "key").select("key", "group", F.col("first").alias("doc_id"))
    wanted = store.put("wanted", wanted)
    own = docs.join(broadcast_if_small(wanted), "doc_id").select("group", "key", "text")
    sets = own.mapInArrow(lean(_sets), "group long, key long, n long, ids binary").withColumn("weight", F.col("n") + DOC_WEIGHT)
    sets = put_in_order(sets, [F.col("group"), F.col("n"), F.col("key")], store, "sets")

    # A row's place in its group, by weight: what other parts hold of the group before it, and its own part.
    held = sets.groupBy("group", part_of().alias("part")).agg(F.sum("weight").alias("held"))
    earlier = Window.partitionBy("group").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    before = held.select("group", "part", F.coalesce(F.sum("held").over(earlier), F.lit(0)).alias("before"))
    inside = Window.partitionBy("group", "part").orderBy("row_at").rowsBetween(Window.unboundedPreceding, -1)
    light = sets.select("group", "key", "n", "weight", "row_at", part_of().alias("part"))
    light = light.withColumn("at", F.coalesce(F.sum("weight").over(inside), F.lit(0)))
    place = light.join(before, ["group", "part"]).withColumn("block", F.expr(f"(before + at) div {BLOCK_WEIGHT}"))
    place = store.put("places", place.select("group", "key", "n", "row_at", "block"))
    seated = store.put("seats", _seats(place, rare))
    rows = sets.select("row_at", "key", "ids").join(seated, "row_at")
    n = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = rows.repartition(n, "group", "left", "right").sortWithinPartitions("group", "left", "right")
    return rows.select("group", "left", "right", "key", "block", "ids").mapInArrow(lean(_linked), "a long, b long")


def _seats(place: DataFrame, rare: DataFrame) -> DataFrame:
    """(row_at, group, block, left, right): each text in the task of its own block, and of every other block that holds a
    text with one of its rare n-grams and near enough in size.

    So a text of a group of many blocks is compared with blocks that may hold a partner, not with the whole group.
    """
    own = place.select("row_at", "group", "block", F.col("block").alias("left"), F.col("block").alias("right"))
    several = place.filter("block > 0").select("group").distinct()
    spread = place.join(several, "group", "left_semi").join(rare, "key").select("id", "group", "block", "row_at", "n")
    held = spread.groupBy("id", "group", "block").agg(F.min("n").alias("low"), F.max("n").alias("high"))
    held = held.withColumnRenamed("block", "other")
    near = "block <> other AND 4 * n >= 3 * low AND 4 * high >= 3 * n"
    met = spread.join(held, ["id", "group"]).filter(near).select("row_at", "group", "block", "other").distinct()
    pair = [F.least("block", "other").alias("left"), F.greatest("block", "other").alias("right")]
    return own.unionAll(met.select("row_at", "group", "block", *pair))
