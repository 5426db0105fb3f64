"""Token ids as canonical length-limited Huffman codes, in files of independently decodable blocks."""

from __future__ import annotations

import math
import os
import re
import zlib
from array import array
from collections import Counter
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from indexday.llm.bpe import BARE_WORDS
from indexday.llm.common import lean, pieces, prepared
from indexday.operators.sizing import broadcast_if_small
from indexday.sources import StageStore

FRAME_CHARS = 4 * 1024 * 1024
BLOCK_TOKENS = 512
PACK_TOKENS = 512 * BLOCK_TOKENS
HELD_BYTES = 16 * 1024 * 1024
WORDS_AT_ONCE = 4096
CHARS_AT_ONCE = 256 * 1024
MAX_BITS = 18
WINDOW = 32


def limited_lengths(counts: np.ndarray, max_bits: int) -> np.ndarray:
    """Code lengths of at most ``max_bits`` that minimise the coded size (package-merge).

    Each level merges the leaves with pairs of the level below; the cheapest 2n - 2 items of the top
    level are followed down, and a leaf's length is the number of levels that use it.
    """
    n = len(counts)
    if n < 2:
        return np.ones(n, np.int64)
    if n > 1 << max_bits:
        raise ValueError(f"{n} symbols need more than {max_bits} bits")
    order = np.argsort(counts, kind="stable")
    leaves = counts[order].astype(np.float64)
    items, is_leaf = leaves, [np.ones(n, bool)]
    for _ in range(1, max_bits):
        even = len(items) // 2 * 2
        pairs = items[0:even:2] + items[1:even:2]
        both = np.concatenate([leaves, pairs])
        at = np.argsort(both, kind="stable")
        items = both[at]
        is_leaf.append(at < n)
    lengths, wanted = np.zeros(n, np.int64), 2 * n - 2
    for here in reversed(is_leaf):
        used = int(here[:wanted].sum())
        lengths[:used] += 1
        wanted = 2 * (wanted - used)
    out = np.empty(n, np.int64)
    out[order] = lengths
    return out


@dataclass(frozen=True)
class Code:
    """A canonical code: symbols in order of length, then id; the lengths alone define the bits."""

    ids: np.ndarray
    lengths: np.ndarray

    @classmethod
    def of(cls, counts: dict[int, int], max_bits: int = MAX_BITS) -> Code:
        ids = np.array(sorted(counts), np.int64)
        lengths = limited_lengths(np.array([counts[i] for i in ids.tolist()], np.float64), max_bits)
        order = np.lexsort((ids, lengths))
        return cls(ids[order], lengths[order])

    @property
    def bits(self) -> int:
        return int(self.lengths[-1]) if len(self.lengths) else 1

    def words(self) -> np.ndarray:
        """The code words: each takes its share of the code space, after those before it."""
        space = 1 << (self.bits - self.lengths)
        return (np.cumsum(space) - space) >> (self.bits - self.lengths)

    def encoder(self) -> tuple[np.ndarray, np.ndarray]:
        size = int(self.ids.max()) + 1 if len(self.ids) else 1
        words, lengths = np.zeros(size, np.int64), np.zeros(size, np.int64)
        words[self.ids], lengths[self.ids] = self.words(), self.lengths
        return words, lengths

    def decoder(self) -> tuple[np.ndarray, np.ndarray]:
        """For each value of the next ``bits`` bits: the id that starts there, and its length."""
        space = 1 << (self.bits - self.lengths)
        ids, lengths = np.repeat(self.ids, space), np.repeat(self.lengths, space)
        left = (1 << self.bits) - len(ids)
        return np.append(ids, np.zeros(left, np.int64)), np.append(lengths, np.ones(left, np.int64))


def pack(ids: np.ndarray, words: np.ndarray, lengths: np.ndarray) -> tuple[bytes, np.ndarray]:
    """(bits of all ids, bit offset of every block's first id); some blocks at a time, so it needs little more than its result.

    Code words that start in the same 32 bits share no bits, so adding them, shifted into 64 bits, joins them; what is
    beyond the 32 bits belongs to the next.
    """
    total = sum(int(lengths[ids[i : i + PACK_TOKENS]].sum()) for i in range(0, len(ids), PACK_TOKENS))
    cells, checkpoints, base = np.zeros((total >> 5) + 2, np.uint32), [np.zeros(0, np.int64)], 0
    for first in range(0, len(ids), PACK_TOKENS):
        part = ids[first : first + PACK_TOKENS]
        sizes = lengths[part]
        ends = np.cumsum(sizes) + base
        starts = ends - sizes
        at = starts >> 5
        shifted = words[part].astype(np.uint64) << (64 - (starts & 31) - sizes).astype(np.uint64)
        new = np.flatnonzero(np.concatenate([[True], at[1:] != at[:-1]]))
        joined, place = np.add.reduceat(shifted, new), at[new]
        cells[place] += (joined >> np.uint64(32)).astype(np.uint32)
        cells[place + 1] += joined.astype(np.uint32)
        checkpoints.append(starts[::BLOCK_TOKENS])
        base = int(ends[-1])
    return cells.astype(">u4").tobytes()[: (total + 7) // 8], np.concatenate(checkpoints)


def unpack(data: bytes, checkpoints: np.ndarray, n: int, table: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """All ids: every block is decoded from its own bit offset, all of them one step at a time."""
    bits = int(math.log2(len(table)))
    raw = np.frombuffer(data + bytes(2 * WINDOW), np.uint8).astype(np.uint32)
    window = (raw[:-3] << 24) | (raw[1:-2] << 16) | (raw[2:-1] << 8) | raw[3:]
    window = window.astype(np.int64)
    at = checkpoints.astype(np.int64)
    out = np.empty((len(at), BLOCK_TOKENS), np.uint32)
    end = len(window) - 1
    for step in range(BLOCK_TOKENS):
        byte = np.minimum(at >> 3, end)
        next_bits = ((window[byte] << (at & 7)) & 0xFFFFFFFF) >> (WINDOW - bits)
        out[:, step] = table[next_bits]
        at = at + lengths[next_bits]
    return out.ravel()[:n]


def _zip(data: bytes) -> bytes:
    return zstandard.ZstdCompressor(level=1).compress(data)


def _unzip(data: bytes) -> bytes:
    return zstandard.ZstdDecompressor().decompress(data)


def _planes(values: np.ndarray) -> bytes:
    """Small integers, byte by byte, so that equal bytes stand together."""
    return _zip(values.astype("<u4").view(np.uint8).reshape(-1, 4).T.tobytes())


def _from_planes(data: bytes) -> np.ndarray:
    return np.frombuffer(_unzip(data), np.uint8).reshape(4, -1).T.copy().view("<u4").ravel()


SPREAD = "part int, frame int, slice int, doc_ids array<long>, sizes array<int>, data binary"
NUMBERS, COUNTS = -1, -2  # rows that are no slice: word numbers of a frame, counts of ids


def _rows(rows: list[tuple]) -> pa.RecordBatch:
    types = [pa.int32(), pa.int32(), pa.int32(), pa.list_(pa.int64()), pa.list_(pa.int32()), pa.binary()]
    names = ["part", "frame", "slice", "doc_ids", "sizes", "data"]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)], names)


def _ragged(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The places of all pieces (start, size), one after the other."""
    ends = np.cumsum(sizes)
    total = int(ends[-1]) if len(ends) else 0
    return np.repeat(starts - (ends - sizes), sizes) + np.arange(total)


def _spread(encode: TextEncoder, slices: int):
    """Sorted documents to frames: the numbers of their word parts in order, and the distinct parts with their counts, by slice.

    A frame holds whole documents of about ``FRAME_CHARS``, or one longer document. A part's slice follows from its bytes.
    """
    split, parts_of = encode.split, encode.parts

    def numbered(words: pa.Array) -> tuple[np.ndarray, pa.Array]:
        """(number of each word, distinct words)."""
        found = words.dictionary_encode()
        return found.indices.to_numpy().astype(np.int64), found.dictionary

    def flush(part: int, frame: int, names: list[int | None], counts: list[int], words: list[pa.Array]) -> pa.RecordBatch:
        counts = np.array(counts, np.int64)
        values, listed = numbered(pa.concat_arrays(words))
        if parts_of is not None:  # each distinct word falls into parts once
            apart, sizes = parts_of(listed.to_numpy(zero_copy_only=False).tolist())
            flat, listed = numbered(pa.array(apart, pa.string()))
            before = np.concatenate([[0], np.cumsum(sizes[values])])
            counts = np.diff(before[np.concatenate([[0], np.cumsum(counts)])])
            values = flat[_ragged((np.cumsum(sizes) - sizes)[values], sizes[values])]
        times = np.bincount(values, minlength=len(listed))
        often = np.argsort(-times, kind="stable")  # frequent words get small numbers
        rank = np.empty(len(often), np.int64)
        rank[often] = np.arange(len(often))
        listed = listed.cast(pa.binary())
        raw = listed.to_numpy(zero_copy_only=False).tolist()
        at = (np.fromiter(map(zlib.crc32, raw), np.int64, len(raw)) % slices)[often]
        rows = [(part, frame, NUMBERS, names, counts, _planes(np.concatenate([[len(listed)], at, rank[values]])))]
        order = np.argsort(at, kind="stable")
        cuts = np.searchsorted(at[order], np.arange(slices + 1))
        by_slice = listed.take(pa.array(often[order]))
        _, offsets, data = by_slice.buffers()
        ends = np.frombuffer(offsets, np.int32, len(by_slice) + 1).astype(np.int64) if len(by_slice) else np.zeros(1, np.int64)
        for s in np.flatnonzero(np.diff(cuts)).tolist():
            a, b = cuts[s], cuts[s + 1]
            head = np.concatenate([[b - a], np.diff(ends[a : b + 1]), times[often[order[a:b]]]])
            rows.append((part, frame, s, None, None, _zip(head.astype("<u4").tobytes() + data[ends[a] : ends[b]].to_pybytes())))
        return _rows(rows)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, frame, held = TaskContext.get().partitionId(), 0, 0
        names, counts, words = [], [], []
        for batch in batches:
            texts = batch.column("text").fill_null("")
            own, flat = split(texts)
            ends = np.cumsum(own)
            first = 0  # of the documents not yet taken
            for i, (name, size) in enumerate(zip(batch.column("doc_id").to_pylist(), pc.utf8_length(texts).to_pylist(), strict=True)):
                if held and held + size > FRAME_CHARS:
                    words.append(flat.slice(first, ends[i] - own[i] - first))
                    yield flush(part, frame, names, counts, words)
                    frame, held, first = frame + 1, 0, int(ends[i] - own[i])
                    names, counts, words = [], [], []
                names.append(name)
                counts.append(int(own[i]))
                held += size + 8
            words.append(flat.slice(first))
        if names:
            yield flush(part, frame, names, counts, words)

    return scan


def _encode_words(make: Callable[[], Callable[[list[str]], Iterator[bytes]]]):
    """Words of a slice from all frames to ids, and the counts of all ids that they stand for.

    Rows come slice by slice. The words of a slice are taken together, up to ``HELD_BYTES``, and each distinct one is
    encoded once; beyond that bound once in each part of that size.
    """

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, total = make(), np.zeros(0, np.int64)

        def ids_of_all(held: list[tuple]) -> Iterator[pa.RecordBatch]:
            nonlocal total
            sizes = np.concatenate([h[3] for h in held])
            ends = np.concatenate([[0], np.cumsum(sizes)])
            buffers = [None, pa.py_buffer(ends.astype(np.int32)), pa.py_buffer(b"".join(h[5] for h in held))]
            found = pa.Array.from_buffers(pa.binary(), len(sizes), buffers).dictionary_encode()
            at = found.indices.to_numpy().astype(np.int64)
            own = list(encode(found.dictionary.cast(pa.string()).to_numpy(zero_copy_only=False).tolist()))
            n_ids = np.fromiter(map(len, own), np.int64, len(own)) // 4
            starts = np.cumsum(n_ids) - n_ids
            flat = np.frombuffer(b"".join(own), "<u4")
            times = np.bincount(at, weights=np.concatenate([h[4] for h in held]), minlength=len(own))
            counted = np.bincount(flat, weights=np.repeat(times, n_ids)).astype(np.int64)
            if len(counted) > len(total):
                total = np.append(total, np.zeros(len(counted) - len(total), np.int64))
            total[: len(counted)] += counted
            first = 0
            for part, frame, s, lengths, _, _ in held:
                here = at[first : first + len(lengths)]
                first += len(lengths)
                ids = flat[_ragged(starts[here], n_ids[here])]
                yield _rows([(part, frame, s, None, None, _planes(np.concatenate([[len(here)], n_ids[here], ids])))])

        held, size = [], 0
        for batch in batches:
            for part, frame, s, data in zip(*(batch.column(c).to_pylist() for c in ("part", "frame", "slice", "data")), strict=True):
                if held and (s != held[0][2] or size > HELD_BYTES):
                    yield from ids_of_all(held)
                    held, size = [], 0
                raw = _unzip(data)
                n = int.from_bytes(raw[:4], "little")
                head = np.frombuffer(raw, "<u4", 2 * n, 4).astype(np.int64)
                held.append((part, frame, s, head[:n], head[n:], raw[4 + 8 * n :]))
                size += len(raw)
        if held:
            yield from ids_of_all(held)
        there = np.flatnonzero(total)
        yield _rows([(None, None, COUNTS, there.tolist(), None, _zip(total[there].astype("<i8").tobytes()))])

    return scan


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for ids, data in zip(batch.column("doc_ids"), batch.column("data"), strict=True):
            n = np.frombuffer(_unzip(data.as_py()), "<i8")
            yield pa.RecordBatch.from_arrays([ids.values, pa.array(n)], ["id", "n"])


def _encode(code: Code, end_id: int):
    """Rows in order of part, frame and slice to packed frames: the word numbers come first, the words' ids after them."""
    codes, lengths = code.encoder()

    def packed(part: int, frame: int, names, counts: np.ndarray, numbers: bytes, found: list[tuple[int, bytes]]) -> pa.RecordBatch:
        values = _from_planes(numbers)
        n = int(values[0])
        at, stream = values[1 : n + 1], values[n + 1 :]
        # one more word that stands for the end of a document
        sizes, starts, flat, held = np.zeros(n + 1, np.int64), np.zeros(n + 1, np.int64), [np.array([end_id], np.int64)], 1
        sizes[n] = 1
        order = np.argsort(at, kind="stable")
        cuts = np.searchsorted(at[order], [s for s, _ in found])
        for (_, data), cut in zip(found, cuts.tolist(), strict=True):
            got = _from_planes(data).astype(np.int64)
            m = int(got[0])
            own = order[cut : cut + m]
            sizes[own] = got[1 : m + 1]
            starts[own] = held + np.cumsum(sizes[own]) - sizes[own]
            flat.append(got[m + 1 :])
            held += len(flat[-1])
        flat = np.concatenate(flat)
        ends = np.cumsum(counts)
        stream = np.insert(stream.astype(np.int64), ends, n)
        before = np.concatenate([[0], np.cumsum(sizes[stream])])
        edges = before[ends + np.arange(1, len(ends) + 1)]
        bits, checkpoints = pack(flat[_ragged(starts[stream], sizes[stream])], codes, lengths)
        return pa.RecordBatch.from_arrays(
            [pa.array([part], pa.int32()), pa.array([frame], pa.int32()), pa.array([names], pa.list_(pa.int64())),
             pa.array([np.diff(edges, prepend=0)], pa.list_(pa.int32())), pa.array([checkpoints], pa.list_(pa.int64())),
             pa.array([bits], pa.binary())],
            ["part", "frame", "doc_ids", "sizes", "checkpoints", "bits"],
        )

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        head, found = None, []
        for batch in batches:
            for i, s in enumerate(batch.column("slice").to_pylist()):
                data = batch.column("data")[i].as_py()
                if s >= 0:
                    found.append((s, data))
                    continue
                if head is not None:
                    yield packed(*head, found)
                counts = np.array(batch.column("sizes")[i].as_py(), np.int64)
                head = (*(batch.column(c)[i].as_py() for c in ("part", "frame", "doc_ids")), counts, data)
                found = []
        if head is not None:
            yield packed(*head, found)

    return scan


def _decode(code: Code):
    table, lengths = code.decoder()

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                row = {c: batch.column(c)[i].as_py() for c in ("start", "doc_ids", "sizes", "bits")}
                sizes = np.array(row["sizes"], np.int64)
                offsets = batch.column("checkpoints")[i].values.to_numpy()
                ids = unpack(row["bits"], offsets, int(sizes.sum()), table, lengths).astype("<u4")
                ends = np.cumsum(sizes)
                data = [ids[a:b].tobytes() for a, b in zip(ends - sizes, ends, strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(row["doc_ids"], pa.int64()), pa.array(row["start"] + ends - sizes, pa.int64()),
                     pa.array(sizes, pa.int64()), pa.array(data, pa.binary())],
                    ["doc_id", "start", "n_tokens", "ids"],
                )

    return scan


class IdFiles:
    """Written ids: ``frames`` (documents in ascending order, their sizes, checkpoints and bits) and the code.

    A frame is one Parquet row: whole documents of about four million characters or one longer document, with a bit
    offset for every 512 ids, so frames and the blocks in them decode independently of each other.
    """

    def __init__(self, store: StageStore):
        self.store = store

    @property
    def code(self) -> Code:
        rows = self.store.get("code").orderBy("length", "id").collect()
        return Code(np.array([r["id"] for r in rows], np.int64), np.array([r["length"] for r in rows], np.int64))

    def read(self) -> DataFrame:
        """(doc_id, start, n_tokens, ids): the documents decoded; ``ids`` are little-endian 32-bit integers.

        ``start`` counts the ids of all documents before: a frame's place in its file, after the files before.
        """
        frames = self.store.get("frames")
        held = frames.select("part", "frame", F.aggregate("sizes", F.lit(0).cast("long"), lambda a, x: a + x).alias("n"))
        files = held.groupBy("part").agg(F.sum("n").alias("n"))
        before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
        files = files.select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("file_start"))
        inside = Window.partitionBy("part").orderBy("frame").rowsBetween(Window.unboundedPreceding, -1)
        held = held.select("part", "frame", F.coalesce(F.sum("n").over(inside), F.lit(0)).alias("frame_start"))
        starts = held.join(files, "part").select("part", "frame", (F.col("file_start") + F.col("frame_start")).alias("start"))
        code = self.code
        if not len(code.ids):
            return frames.sparkSession.createDataFrame([], "doc_id long, start long, n_tokens long, ids binary")
        placed = frames.join(broadcast_if_small(starts), ["part", "frame"])
        placed = placed.select("start", "doc_ids", "sizes", "checkpoints", "bits")
        return placed.mapInArrow(lean(_decode(code)), "doc_id long, start long, n_tokens long, ids binary")


def write_ids(
    docs: DataFrame, encode: TextEncoder, end_id: int, store: StageStore | None = None, max_bits: int = MAX_BITS
) -> IdFiles:
    """Encode (doc_id, text), append ``end_id`` to each document and write the ids in ascending doc_id order.

    Documents are sorted into ranges of doc_id, whose texts fall into words; a frame of documents keeps its word
    numbers, and its distinct words go to slices by hash, where each is encoded once and counted (:func:`_spread`,
    :func:`_encode_words`). Counts of all ids, one line per id of the vocabulary and slice, are added up and give one canonical
    code for all. The words' ids return to their frame, which is put in order and packed in one pass; ids are never
    stored unpacked. Tasks hold a frame, or the words they remember, both bounded in bytes; a text or word beyond
    the bound is held alone.

    Null and empty texts hold the end id alone. Rows with equal doc_id follow each other by text, a null
    doc_id comes first; repeated rows are written each. An empty table writes no frames. Other columns are
    not read.
    """
    spark = docs.sparkSession
    store = store or prepared(spark)
    prepared(spark)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    n = pieces(docs)
    rows = rows.repartitionByRange(n, "doc_id").sortWithinPartitions("doc_id", "text")
    spread = store.put("spread", rows.mapInArrow(lean(_spread(encode, n)), SPREAD))
    words = spread.filter(F.col("slice") >= 0).repartition(n, "slice").sortWithinPartitions("slice")
    found = store.put("found", words.mapInArrow(lean(_encode_words(encode.make)), SPREAD))
    counts = found.filter(F.col("slice") == COUNTS).mapInArrow(_count, "id long, n long").groupBy("id").agg(F.sum("n").alias("n"))
    numbers = spread.filter(F.col("slice") == NUMBERS)
    n_docs = numbers.agg(F.sum(F.size("sizes"))).first()[0] or 0
    times = Counter({r["id"]: r["n"] for r in counts.collect()})
    times.update({end_id: n_docs} if n_docs else {})
    code = Code.of(times, max_bits)
    lines = list(zip(code.ids.tolist(), code.lengths.tolist(), strict=True))
    store.put("code", spark.createDataFrame(lines, "id long, length long"))
    both = numbers.unionByName(found.filter(F.col("slice") >= 0))
    both = both.repartitionByRange(n, "part", "frame").sortWithinPartitions("part", "frame", "slice")
    frames = "part int, frame int, doc_ids array<long>, sizes array<int>, checkpoints array<long>, bits binary"
    store.put("frames", both.mapInArrow(lean(_encode(code, end_id)), frames))
    store.drop("spread", "found")
    return IdFiles(store)


_OTHER_WHITE = "[\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]"


def _splitter(words: str | None) -> Callable[[pa.Array], tuple[np.ndarray, pa.Array]]:
    """(words of each text, all words) of an array of texts: matches of a pattern, or whole texts that are not empty."""

    def found(lists: pa.Array) -> tuple[np.ndarray, pa.Array]:
        flat, sizes = lists.flatten(), np.diff(lists.offsets.to_numpy())
        there = pc.binary_length(flat).to_numpy(zero_copy_only=False) > 0
        owner = np.repeat(np.arange(len(lists)), sizes)[there]
        return np.bincount(owner, minlength=len(lists)), flat.filter(pa.array(there))

    if words is None:
        return lambda texts: found(pa.ListArray.from_arrays(pa.array(np.arange(len(texts) + 1, dtype=np.int32)), texts))
    pattern = re.compile(words)

    def by_pattern(texts: pa.Array) -> pa.Array:
        return pa.array([pattern.findall(t) for t in texts.to_pylist()], pa.list_(pa.string()))

    def bare(texts: pa.Array) -> tuple[np.ndarray, pa.Array]:
        # Arrow knows ASCII white space; texts with other white space are matched one by one
        special = np.flatnonzero(pc.match_substring_regex(texts, _OTHER_WHITE).to_numpy(zero_copy_only=False))
        lists = pc.ascii_split_whitespace(texts)
        if len(special):
            place = np.arange(len(texts))
            place[special] = len(texts) + np.arange(len(special))
            lists = pa.concat_arrays([lists, by_pattern(texts.take(pa.array(special)))]).take(pa.array(place))
        return found(lists)

    return bare if words == BARE_WORDS else lambda texts: found(by_pattern(texts))


@lru_cache(maxsize=1)
def _tokenizer(text: str):
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    return Tokenizer.from_str(text)


@dataclass(frozen=True)
class TextEncoder:
    """How texts fall into words, and what makes, in a task, the function from words to their ids as little-endian 32-bit integers."""

    split: Callable[[pa.Array], tuple[np.ndarray, pa.Array]]
    make: Callable[[], Callable[[list[str]], Iterator[bytes]]]
    parts: Callable[[list[str]], tuple[list[str], np.ndarray]] | None = None


_APART = re.compile(r"([a-z0-9à-öø-ÿ])([!-&(-/:-@\[-`{-~]+)$", re.MULTILINE)
_ODD = re.compile("[<\u0100-\U0010ffff]")


def lower_parts(words: list[str]) -> tuple[list[str], np.ndarray]:
    """(parts of all words, number of parts of each) that a tokenizer encodes apart which lower-cases and tells letters and digits from other characters.

    Words of Latin-1 alone are lower-cased, which there is the same by any rule, and lose the signs at their end; an apostrophe may begin
    a part of its own, so it stays. What may hold a special token stays as it is. Words hold no white space, so they are handled
    as the lines of one text.
    """
    words, kept = list(words), {}
    text = "\n".join(words)
    if _ODD.search(text):
        ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1)
        odd = np.unique(np.searchsorted(ends, [m.start() for m in _ODD.finditer(text)], "right"))
        kept = {i: words[i] for i in odd.tolist()}
        for i in kept:
            words[i] = ""
        text = "\n".join(words)
    lines = text.lower().split("\n") if words else []
    signed = [i for i, w in enumerate(lines) if w and not w[-1].isalnum()]
    apart = _APART.sub("\\1\t\\2", "\n".join([lines[i] for i in signed])).split("\n")
    sizes = np.ones(len(words), np.int64)
    for i, w in zip(signed, apart, strict=False):
        if "\t" in w:
            lines[i] = w
            sizes[i] = 2
    parts = "\n".join(lines).replace("\t", "\n").split("\n") if words else []
    starts = np.cumsum(sizes) - sizes
    for i, word in kept.items():
        parts[starts[i]] = word
    return parts, sizes


def tokenizer(
    path: str, words: str | None = None, parts: Callable[[list[str]], tuple[list[str], np.ndarray]] | None = None
) -> TextEncoder:
    """The encoder of a tokenizer file, read here and sent to the tasks with their code.

    ``words`` is a pattern whose matches the tokenizer encodes independently of what is around them and of
    what is between them, as words of a tokenizer that drops white space. Without it a text is one word. ``parts`` takes
    words apart into what the tokenizer encodes independently too and fewer distinct words remain of, as :func:`lower_parts`.
    """
    with open(path, encoding="utf-8") as f:
        text = f.read()

    def make():
        own = _tokenizer(text)

        def encode(words: list[str]) -> Iterator[bytes]:
            some, held = [], 0
            for i, word in enumerate(words):
                some.append(word)
                held += len(word)
                if len(some) == WORDS_AT_ONCE or held >= CHARS_AT_ONCE or i == len(words) - 1:
                    for found in own.encode_batch_fast(some, add_special_tokens=False):
                        yield array("I", found.ids).tobytes()
                    some, held = [], 0

        return encode

    return TextEncoder(_splitter(words), make, parts)


def ids_of(spark: SparkSession, path: str) -> IdFiles:
    """Files written earlier into the folder ``path``."""
    return IdFiles(StageStore(spark, root=path))
