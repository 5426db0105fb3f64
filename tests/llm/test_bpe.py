from __future__ import annotations

import hashlib
import random

import public_tokenizers
import tiktoken
from conftest import SMALL

from indexday.llm import bpe
from indexday.llm.queries import op7_byte_bpe

RANKS = bpe.load_ranks(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))
WHOLE = tiktoken.Encoding("whole", pat_str=public_tokenizers.PATTERN, mergeable_ranks=RANKS, special_tokens={})


def test_words_never_cut_a_match():
    random.seed(7)
    letters = " \n\t\r\x0b\x0c\x1c\x1f\x85\xa0 　'stabE1é!?中́\U0001f600"
    for _ in range(3000):
        text = "".join(random.choices(letters, k=random.randint(0, 14)))
        assert "".join(bpe.WORDS.findall(text)) == text
        assert [i for w in bpe.WORDS.findall(text) for i in WHOLE.encode_ordinary(w)] == WHOLE.encode_ordinary(text)


def test_edge_cases(frame, monkeypatch):
    docs = [(1, "it's  a\n\n test"), (2, None), (3, ""), (4, "same"), (4, "same"), (None, "no id"), (6, "café 中文 " * 40_000), (7, " \t ")]
    df = frame([(*d, 1) for d in docs], "doc_id long, text string, decoded int").repartition(3)
    found = bpe.decode(bpe.encode(df, RANKS, public_tokenizers.PATTERN), RANKS).collect()
    want = sorted((str(i), WHOLE.encode_ordinary(t or ""), (t or "").encode()) for i, t in docs)
    assert sorted((str(r.doc_id), r.ids, bytes(r.decoded)) for r in found) == want


def test_empty_and_null_ids(frame):
    assert bpe.encode(frame([], "doc_id long, text string"), RANKS, public_tokenizers.PATTERN).collect() == []
    null = frame([(1, None)], "doc_id long, ids array<int>")
    assert [bytes(r.decoded) for r in bpe.decode(null, RANKS).collect()] == [b""]


def test_query(spark):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()}
    query = op7_byte_bpe(spark, SMALL)
    found = query.collect()
    assert len(found) == len(docs)
    assert not [t.name for t in spark.catalog.listTables() if t.name.startswith("bundles_")]
    assert "Bucketed: true" in query._jdf.queryExecution().toString()
    for r in found:
        ids = WHOLE.encode_ordinary(docs[r.doc_id])
        digest = hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert (r.n_tokens, r.ids_sha256) == (len(ids), digest)
        assert r.decoded_sha256 == hashlib.sha256(docs[r.doc_id].encode()).hexdigest()
