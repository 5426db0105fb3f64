"""Byte-level BPE: every distinct word is encoded once, and ids are joined back by position."""

from __future__ import annotations

import base64
import re
import uuid
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from indexday.llm.common import lean, prepared
from indexday.sources import StageStore

BUNDLE_CHARS = 8 * 1024 * 1024
BUNDLE_DOCS = 60_000
KNOWN_WORDS = 300_000
WORDS_AT_ONCE = 100_000
DOCS_AT_ONCE = 64

# White space as Unicode defines it, which is what \s means to the library's pattern. Every match of the
# pattern that reaches from a character into white space starts there, so a word is taken with the white
# space before it: no match crosses such a boundary, and none looks past the end of the word.
_OTHER_WHITE = (0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000)
_WHITE = r"\t-\r " + "".join(map(chr, _OTHER_WHITE))
BARE_WORDS = f"[^{_WHITE}]+"
WORDS = re.compile(f"[{_WHITE}]*[^{_WHITE}]+|[{_WHITE}]+")


def load_ranks(path: str) -> dict[bytes, int]:
    """Token bytes and their ranks."""
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}


def _word_encoder(ranks: dict[bytes, int], pattern: str):
    import tiktoken

    return tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=ranks, special_tokens={}).encode_ordinary


def _zip(data: bytes) -> bytes:
    return zstandard.ZstdCompressor(level=3).compress(data)


def _unzip(data: bytes) -> bytes:
    return zstandard.ZstdDecompressor().decompress(data)


def _planes(values: np.ndarray) -> bytes:
    """Small integers, byte by byte, so that equal bytes stand together."""
    return _zip(values.astype("<u4").view(np.uint8).reshape(-1, 4).T.tobytes())


def _from_planes(data: bytes) -> np.ndarray:
    return np.frombuffer(_unzip(data), np.uint8).reshape(4, -1).T.copy().view("<u4").ravel()


def _bundle(slices: int):
    """Texts to bundles: the words of some documents as numbers in order, and the distinct words by slice."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, number = TaskContext.get().partitionId(), 0
        keys, counts, stream, place, held = [], [], [], {}, 0

        def flush():
            # Frequent words get small numbers; a word's slice follows from its own bytes.
            values = np.concatenate(stream) if stream else np.zeros(0, np.int64)
            often = np.argsort(-np.bincount(values, minlength=len(place)), kind="stable")
            rank = np.empty(len(often), np.int64)
            rank[often] = np.arange(len(often))
            words = np.array(list(place), object)[often] if place else np.zeros(0, object)
            raw = [w.encode() for w in words]
            at = np.array([xxhash.xxh3_64_intdigest(w) % slices for w in raw], np.int64)
            rows = {"bundle": [], "slice": [], "keys": [], "counts": [], "data": []}

            def add(slice_no, own_keys, own_counts, data):
                for name, value in zip(rows, ((part << 32) | number, slice_no, own_keys, own_counts, data), strict=True):
                    rows[name].append(value)

            add(-1, keys, counts, _planes(np.concatenate([[len(at)], at, rank[values]])))
            for s in np.unique(at).tolist():
                own = np.flatnonzero(at == s)
                # sizes first, then the words; own keeps the order in which ids return
                sizes = np.array([len(raw[i]) for i in own], "<u4").tobytes()
                add(s, [len(own)], [], _zip(sizes + b"".join(raw[i] for i in own)))
            types = [pa.int64(), pa.int32(), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.binary()]
            return pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(rows.values(), types, strict=True)], list(rows))

        for batch in batches:
            for key, text in zip(batch.column("key").to_pylist(), batch.column("text").to_pylist(), strict=True):
                words = WORDS.findall(text or "")
                for w in words:
                    if w not in place:
                        place[w] = len(place)
                keys.append(key)
                counts.append(len(words))
                stream.append(np.fromiter(map(place.__getitem__, words), np.int64, len(words)))
                held += len(text or "")
                if held >= BUNDLE_CHARS or len(keys) >= BUNDLE_DOCS:
                    yield flush()
                    keys, counts, stream, place, held, number = [], [], [], {}, 0, number + 1
        if keys:
            yield flush()

    return scan


def _encode_words(ranks: dict[bytes, int], pattern: str):
    """Words of one slice from all bundles to ids; each distinct word is encoded once."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, known = _word_encoder(ranks, pattern), {}
        for batch in batches:
            out = []
            for keys, data in zip(batch.column("keys").to_pylist(), batch.column("data").to_pylist(), strict=True):
                raw, n = _unzip(data), keys[0]
                ends = np.cumsum(np.frombuffer(raw[: 4 * n], "<u4")) + 4 * n
                ids, start = [], 4 * n
                for end in ends.tolist():
                    word = raw[start:end]
                    start = end
                    own = known.get(word)
                    if own is None:
                        if len(known) >= KNOWN_WORDS:
                            known.clear()
                        own = known[word] = array("I", encode(word.decode())).tobytes()
                    ids.append(own)
                sizes = np.fromiter(map(len, ids), np.int64, n) // 4
                out.append(_planes(np.concatenate([[n], sizes, np.frombuffer(b"".join(ids), np.uint32)])))
            yield pa.RecordBatch.from_arrays(
                [batch.column("bundle"), batch.column("slice"), pa.array(out, pa.binary())], ["bundle", "slice", "ids"]
            )

    return scan


def _ragged(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The places of all pieces (start, size), one after the other."""
    ends = np.cumsum(sizes)
    total = int(ends[-1]) if len(ends) else 0
    return np.repeat(starts - (ends - sizes), sizes) + np.arange(total)


def _reassemble(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A bundle's word numbers and its words' ids to the ids of each document, in order of position."""
    for batch in batches:
        for i in range(batch.num_rows):
            values = _from_planes(batch.column("data")[i].as_py()).astype(np.int64)
            n = int(values[0])
            at, stream = values[1 : n + 1], values[n + 1 :]
            sizes, starts, flat, held = np.zeros(n, np.int64), np.zeros(n, np.int64), [], 0
            for x in batch.column("found")[i].as_py() or []:
                got = _from_planes(x["ids"]).astype(np.int64)
                own, m = np.flatnonzero(at == x["slice"]), int(got[0])
                sizes[own] = got[1 : m + 1]
                starts[own] = held + np.cumsum(sizes[own]) - sizes[own]
                flat.append(got[m + 1 :])
                held += len(flat[-1])
            flat = np.concatenate(flat).astype(np.int32) if flat else np.zeros(0, np.int32)
            words = batch.column("counts")[i].values.to_numpy()
            keys, ends = batch.column("keys")[i].values, np.cumsum(words)
            first = 0
            while first < len(words):  # documents of some words at a time
                begin = ends[first] - words[first]
                last = max(first + 1, int(np.searchsorted(ends, begin + WORDS_AT_ONCE, "right")))
                part = stream[begin : ends[last - 1]]
                before = np.concatenate([[0], np.cumsum(sizes[part])])
                offsets = before[np.concatenate([[0], ends[first:last] - begin])]
                ids = pa.array(flat[_ragged(starts[part], sizes[part])])
                yield pa.RecordBatch.from_arrays(
                    [keys.slice(first, last - first), pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), ids)],
                    ["key", "ids"],
                )
                first = last


def encode(
    docs: DataFrame, ranks: dict[bytes, int], pattern: str, id_col: str = "doc_id", text_col: str = "text",
    store: StageStore | None = None, with_bytes: bool = False,
) -> DataFrame:
    """(id_col, ids): one row for every row of ``docs``, each match of ``pattern`` merged by ``ranks``.

    Texts fall into words at white space. A task numbers the words of some documents (a bundle), keeps the
    numbers in order of position, and deals the bundle's distinct words out by their hash, so a word that is
    in every document costs one entry per bundle. A slice encodes each distinct word once. The ids return to
    the bundle, whose word numbers put them in place. ``with_bytes`` adds ``decoded`` as :func:`decode` does, in
    the same worker.

    Null and empty texts have no ids. Repeated rows and ids give a row each, a null id stays null; other
    columns are not read. An empty table gives no rows.
    """
    spark = docs.sparkSession
    own = prepared(spark)
    store = store or own
    slices = int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = docs.select(F.col(id_col).cast("long").alias("key"), F.col(text_col).cast("string").alias("text"))
    schema = "bundle long, slice int, keys array<long>, counts array<long>, data binary"
    bundles = rows.mapInArrow(lean(_bundle(slices)), schema)
    # Bucketed by bundle, so that the word numbers meet their ids without being shuffled. The frame read here knows the
    # files and their buckets; the catalog entry is not needed any longer, and with a path of its own the table leaves its files.
    name = f"bundles_{uuid.uuid4().hex}"
    try:
        bundles.write.bucketBy(slices, "bundle").option("path", store.target("bundles")).saveAsTable(name)
        bundles = spark.table(name)
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {name}")
    words = bundles.filter("slice >= 0").select("bundle", "slice", "keys", "data").repartition(slices, "slice")
    found = words.mapInArrow(lean(_encode_words(ranks, pattern)), "bundle long, slice int, ids binary")
    found = found.groupBy("bundle").agg(F.collect_list(F.struct("slice", "ids")).alias("found"))
    numbers = bundles.filter("slice < 0").select("bundle", "keys", "counts", "data")
    joined = numbers.join(found, "bundle", "left").select("keys", "counts", "data", "found")
    if not with_bytes:
        return joined.mapInArrow(lean(_reassemble), "key long, ids array<int>").withColumnRenamed("key", id_col)
    to_bytes = _decode(ranks, 1)
    both = joined.mapInArrow(lean(lambda batches: to_bytes(_reassemble(batches))), "key long, ids array<int>, decoded binary")
    return both.withColumnRenamed("key", id_col)


def _decode(ranks: dict[bytes, int], ids_at: int):
    size = max(ranks.values(), default=-1) + 1
    sizes = np.zeros(size, np.int64)
    for token, rank in ranks.items():
        sizes[rank] = len(token)
    by_rank = sorted(ranks, key=ranks.__getitem__)
    blob = np.frombuffer(b"".join(by_rank), np.uint8)
    starts = np.cumsum(sizes) - sizes

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (b.slice(i, DOCS_AT_ONCE) for b in batches for i in range(0, b.num_rows, DOCS_AT_ONCE)):
            lists = batch.column(ids_at)
            ids, offsets = lists.flatten().to_numpy(), lists.offsets.to_numpy()
            data = blob[_ragged(starts[ids], sizes[ids])]
            before = np.concatenate([[0], np.cumsum(sizes[ids])])
            ends = before[offsets - offsets[0]]
            texts = pa.Array.from_buffers(
                pa.binary(), len(lists), [None, pa.py_buffer(ends.astype(np.int32)), pa.py_buffer(data)]
            )
            yield pa.RecordBatch.from_arrays([*batch.columns, texts], [*batch.schema.names, "decoded"])

    return scan


def decode(encoded: DataFrame, ranks: dict[bytes, int], ids_col: str = "ids") -> DataFrame:
    """``encoded`` with ``decoded``, the bytes of its ids.

    The token-byte table, one line per token of the vocabulary, goes to every task and is joined there by id.
    A null list of ids decodes to no bytes; an id outside the table is an error. A column named decoded is replaced.
    """
    prepared(encoded.sparkSession)
    encoded = encoded.drop("decoded")
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in encoded.schema.fields)
    filled = encoded.withColumn(ids_col, F.coalesce(ids_col, F.array().cast("array<int>")))
    return filled.mapInArrow(lean(_decode(ranks, encoded.columns.index(ids_col))), f"{schema}, decoded binary")


def digests(decoded: DataFrame) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256) of decoded documents: ids as decimals joined by commas."""
    return decoded.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )
