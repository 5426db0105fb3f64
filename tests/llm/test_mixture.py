from __future__ import annotations

import re
from collections import defaultdict

import pytest
from conftest import SMALL

from indexday.llm.mixture import mix
from indexday.llm.queries import op5_source_mixture


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def targets(sizes, weights=(3, 1, 2)):
    names = sorted((n for n in sizes if n is not None), key=lambda n: n.encode()) + ([None] if None in sizes else [])
    weight = {n: weights[i % 3] for i, n in enumerate(names)}
    total, full = 1.5 * sum(sizes.values()), {}
    while True:
        left = total - sum(full.values())
        rest = sum(w for n, w in weight.items() if n not in full)
        over = {n: 2.0 * sizes[n] for n, w in weight.items() if n not in full and left * w / rest > 2 * sizes[n]}
        if not over:
            return {n: full.get(n, left * w / rest if rest else 0.0) for n, w in weight.items()}
        full |= over


def check(docs, found):
    sizes, taken = defaultdict(int), defaultdict(int)
    for _, source, text in docs:
        sizes[source] += len(words(text))
    want = targets(sizes)
    for r in found:
        assert r["source_size"] == sizes[r["source"]] and 0 <= r["taken"] <= 2 * r["size"]
        assert r["target"] == pytest.approx(want[r["source"]])
        taken[r["source"]] += r["taken"]
    assert all(abs(taken[s] - want[s]) <= 0.5 + 1e-6 for s in sizes)


DOCS = [
    *[(i, "big", f"w{i} " * (i % 9)) for i in range(120)],
    *[(200 + i, "z", "one two\tthree\n" * 30) for i in range(8)],
    *[(300 + i, None, "same words here") for i in range(5)],
    (400, "a", "x " * 20_000), (401, "a", None), (402, "a", ""), (None, "b", "no id at all"), (403, "b", "two words"),
    (403, "b", "two words"), (404, "empty", " \n"), (405, "\U0001f600", "p q r s t"), (406, "￮", "u v"),
]


@pytest.mark.parametrize("block_words", [512, 7])
def test_targets_are_met(frame, block_words):
    df = frame([(*d, 1.0) for d in DOCS], "doc_id long, source string, text string, target double").repartition(4)
    mixture = mix(df, block_words=block_words, shard_slots=16)
    found = mixture.taken().collect()
    assert len(found) == len(DOCS)
    check(DOCS, found)
    again = mix(df.repartition(2), block_words=block_words, shard_slots=16).taken()
    key = lambda rows: sorted((str(r["doc_id"]), r["taken"]) for r in rows)
    assert key(found) == key(again.collect())
    slots = mixture.slots.collect()
    assert len({(s.shard, s.slot) for s in slots}) == len(slots)
    assert len({(s.source_no, s.block, s.epoch) for s in slots}) == len(slots)
    assert all(s.slot < 16 for s in slots)


def test_documents_hold_the_taken_words(frame):
    df = frame(DOCS, "doc_id long, source string, text string")
    mixture = mix(df, block_words=7)
    sizes = {r.row_at: (r.taken, r.text) for r in mixture.taken().collect()}
    copies = defaultdict(int)
    for r in mixture.documents().collect():
        full = sizes[r.row_at][1]
        copies[r.row_at] += len(words(r.text))
        assert r.text == full if r.whole else set(words(r.text)) <= set(words(full))
    assert dict(copies) == {k: v for k, (v, _) in sizes.items() if v}


def test_empty(frame):
    df = frame([], "doc_id long, source string, text string")
    assert mix(df).taken().collect() == []
    wordless = mix(frame([(1, "a", None)], "doc_id long, source string, text string"))
    assert [(r.taken, r.target) for r in wordless.taken().collect()] == [(0, 0.0)]
    assert wordless.documents().collect() == []


def test_query(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "source", "text").collect()
    source = {d.doc_id: d.source for d in docs}
    found = [r.asDict() | {"source": source[r.doc_id]} for r in op5_source_mixture(spark, SMALL).collect()]
    check(docs, found)
