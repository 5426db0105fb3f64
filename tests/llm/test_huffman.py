from __future__ import annotations

import heapq
import random
import zlib
from unittest import mock

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute
from conftest import SMALL
from tokenizers import Tokenizer

from indexday.llm import bpe, huffman
from indexday.llm.common import prepared
from indexday.llm.huffman import Code, limited_lengths, pack, unpack, write_ids
from indexday.llm.queries import op3_huffman_ids

PATH = public_tokenizers.path("word_bpe_49k.json")


def huffman_size(counts):
    heap, total = list(counts), 0
    heapq.heapify(heap)
    while len(heap) > 1:
        both = heapq.heappop(heap) + heapq.heappop(heap)
        total += both
        heapq.heappush(heap, both)
    return total


def test_lengths_are_optimal_within_the_limit():
    counts = np.array([1, 1, 2, 3, 5, 8, 13, 21, 34, 55], float)
    assert (limited_lengths(counts, 16) * counts).sum() == huffman_size(counts.tolist())
    short = limited_lengths(counts, 4)
    assert short.max() == 4 and sum(2.0**-x for x in short) <= 1
    assert (short * counts).sum() >= huffman_size(counts.tolist())


def test_bits_round_trip():
    rng = np.random.default_rng(1)
    for ids in (rng.zipf(1.3, 5000) % 700, np.array([3]), np.full(2000, 9), np.arange(1500)):
        code = Code.of(dict(zip(*[x.tolist() for x in np.unique(ids, return_counts=True)], strict=True)))
        data, checkpoints = pack(ids, *code.encoder())
        assert np.array_equal(unpack(data, checkpoints, len(ids), *code.decoder()), ids)
        again = Code(code.ids, code.lengths)
        assert np.array_equal(again.words(), code.words())


def check(docs, found):
    tokenizer, start = Tokenizer.from_file(PATH), 0
    for (name, text), r in zip(docs, found, strict=True):
        ids = np.array([*tokenizer.encode(text or "", add_special_tokens=False).ids, 2], "<u4").tobytes()
        assert (r.doc_id, r.start, r.n_tokens, bytes(r.ids)) == (name, start, len(ids) // 4, ids)
        start += len(ids) // 4


def test_edge_cases(spark, frame, monkeypatch):
    docs = [(None, "no id"), (1, None), (2, ""), (3, "Same text"), (3, "Same text"), (4, "long é中 " * 30_000), (9, " \n\t")]
    df = frame([(*d, 0) for d in docs], "doc_id long, text string, start int").repartition(3)
    for words in (None, bpe.BARE_WORDS):
        files = write_ids(df, huffman.tokenizer(PATH, words), 2)
        check(docs, files.read().orderBy("start").collect())
        found = huffman.ids_of(spark, files.store.root).read().orderBy("start").collect()
        assert [r.doc_id for r in found] == [d for d, _ in docs]


def test_white_space_and_control_characters(frame):
    rnd = random.Random(2)
    letters = "ab1'sé \u0301\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f\x85\xa0\u1680\u2003\u2028\u202f\u3000中\U0001f600<|endoftext|>"
    docs = [(i, "".join(rnd.choices(letters, k=rnd.randint(0, 30)))) for i in range(1500)]
    docs += [(2000, "x<|endoftext|>. X<|ENDOFTEXT|>. It's. it'S' don't!? É.É ÀÉ... o' 'tis rock'n'roll. a' .b 5. $$$ x_y_ <b>. K İ. ß. ſ.")]
    for parts in (None, huffman.lower_parts):
        files = write_ids(frame(docs, "doc_id long, text string"), huffman.tokenizer(PATH, bpe.BARE_WORDS, parts), 2)
        check(docs, files.read().orderBy("start").collect())


def test_parts_are_encoded_apart():
    """A million random words of the characters that matter: ids of the parts are those of the word."""
    rnd = random.Random(8)
    letters = "aZ09éÉßµªº×÷²½'\"-_.,!?$&()<>|[]{}~`^/\\\xa1\xad\xb7\u0301ſKİς中"
    words = sorted({"".join(rnd.choices(letters, k=rnd.randint(1, 6))) for _ in range(200_000)})
    tokenizer = Tokenizer.from_file(PATH)
    whole = [e.ids for e in tokenizer.encode_batch_fast(words, add_special_tokens=False)]
    parts, sizes = huffman.lower_parts(words)
    flat = iter(tokenizer.encode_batch_fast(parts, add_special_tokens=False))
    assert [[i for _ in range(n) for i in next(flat).ids] for n in sizes.tolist()] == whole
    assert (sizes > 1).sum() > 10_000 and next(flat, None) is None
    assert huffman.lower_parts([])[0] == [] and huffman.lower_parts(["İ<"])[0] == ["İ<"]


def test_frames_are_bounded_and_in_order(spark, frame, monkeypatch):
    monkeypatch.setattr(huffman, "FRAME_CHARS", 3000)
    monkeypatch.setattr(huffman, "PACK_TOKENS", 1024)
    monkeypatch.setattr(huffman, "HELD_BYTES", 2000)
    rnd = random.Random(4)
    docs = [(i, " ".join(rnd.choices(["the", "of", "word", "x" * 300, f"own{i}"], k=rnd.randint(0, 400)))) for i in range(60)]
    files = write_ids(frame(docs, "doc_id long, text string").repartition(7), huffman.tokenizer(PATH, bpe.BARE_WORDS), 2)
    frames = files.store.get("frames")
    assert frames.count() > 60 // 4 and frames.selectExpr("max(size(doc_ids))").first()[0] < 60
    check(docs, files.read().orderBy("start").collect())
    order = [d for r in frames.orderBy("part", "frame").collect() for d in r.doc_ids]
    assert order == sorted(order)


def test_very_long_words_take_bounded_memory():
    """Two thousand words of 20 kB each, which is no text that a tokenizer should be given at once."""
    encoder = huffman.tokenizer(PATH, bpe.BARE_WORDS)
    words = [(f"w{i}" * 5000)[:20_000] for i in range(2000)]
    data = huffman._spread(encoder, 1)
    with spark_task():
        frames = list(data(iter([pa.RecordBatch.from_pydict({"doc_id": [1], "text": [" ".join(words)]})])))
    rows = pa.Table.from_batches(frames).filter(pa.compute.greater_equal(pa.Table.from_batches(frames)["slice"], 0))
    before = resident()
    most = 0
    for _ in huffman._encode_words(encoder.make)(iter(rows.to_batches())):
        most = max(most, resident() - before)
    assert most < 700


def spark_task():
    class Task:
        def partitionId(self):
            return 0

    return mock.patch.object(huffman.TaskContext, "get", lambda: Task())


def resident():
    """MB of this process."""
    with open("/proc/self/statm") as f:
        return int(f.read().split()[1]) * 4096 // 2**20


def test_empty(spark, frame):
    files = write_ids(frame([], "doc_id long, text string"), huffman.tokenizer(PATH), 2, prepared(spark))
    assert files.read().collect() == []


def test_query(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").orderBy("doc_id").select("doc_id", "text").collect()
    found = op3_huffman_ids(spark, SMALL).orderBy("doc_id").collect()
    tokenizer, start = Tokenizer.from_file(PATH), 0
    for d, r in zip(docs, found, strict=True):
        ids = np.array([*tokenizer.encode(d.text, add_special_tokens=False).ids, 2], "<u4").tobytes()
        assert tuple(r) == (d.doc_id, start, len(ids) // 4, zlib.crc32(ids))
        start += len(ids) // 4
