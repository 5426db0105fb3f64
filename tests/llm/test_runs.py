from __future__ import annotations

import hashlib
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from indexday.llm import queries
from indexday.llm.runs import Grammar, collapse, find_runs, periodic_runs, stretches, strongest

SCHEMA = "doc_id long, text string"


def plain_runs(words):
    """All runs by comparing the words at every distance."""
    n, found = len(words), set()
    for q in range(1, n // 4 + 1):
        i = 0
        while i + q < n:
            start = i
            while i + q < n and words[i] == words[i + q]:
                i += 1
            length = i + q - start
            inside = words[start : start + length]
            if length >= max(6, 4 * q) and all(inside[p:] != inside[:-p] for p in range(1, q)):
                found.add((start, length, q))
            i += i == start
    return sorted(found, key=lambda r: (r[0], r[2]))


def made_up(rnd):
    words, letters = [], rnd.randint(1, 5)
    while len(words) < rnd.randint(0, 90):
        kind = rnd.random()
        block = [rnd.randrange(letters) for _ in range(rnd.randint(1, 7))]
        words += block * (1 if kind < 0.5 else rnd.randint(2, 7))
        if kind > 0.9:
            words += words[-rnd.randint(1, len(words)) :]
    return words


@pytest.mark.parametrize("seed", range(5))
def test_runs_by_brute_force(seed):
    rnd = random.Random(seed)
    for _ in range(150):
        docs = [made_up(rnd) for _ in range(rnd.randint(1, 5))]
        sizes = [len(d) for d in docs]
        ids = np.array([w for d in docs for w in d], np.int64)
        first = np.concatenate([[0], np.cumsum(sizes)])
        found = find_runs(ids, np.repeat(np.arange(len(docs)), sizes)).tolist()
        for i, words in enumerate(docs):
            assert [(s - first[i], n, q) for doc, s, n, q in found if doc == i] == plain_runs(words)


def test_grammar_derives_the_words_and_names_a_pair_once():
    words = np.array([1, 2, 3] * 9 + [4, 1, 2, 3, 5] + [7] * 11, np.int64)
    grammar = Grammar(words, np.zeros(len(words), np.int64))
    for rule, place in zip(grammar.rules.tolist(), grammar.places.tolist(), strict=True):
        there = words[place : place + grammar.sizes[rule]]
        assert there.tolist() == grammar.derived(words, rule).tolist()
    inner = {int(p + grammar.splits[r]) for r, p in zip(grammar.rules, grammar.places, strict=True)}
    assert inner == set(range(1, len(words)))  # every boundary is some rule's
    assert (grammar.rules == grammar.rules[0]).sum() > 1


def test_stretches_drop_what_no_run_can_hold():
    words = np.array([9, 1, 1, 1, 1, 1, 1, 8, 2, 3, 2, 3, 2, 3, 5, 2, 3, 2], np.int64)
    at, part = stretches(words, np.zeros(len(words), np.int64))
    assert set(range(1, 7)) <= set(at.tolist()) and len(set(part[np.isin(at, range(1, 7))].tolist())) == 1


@pytest.mark.parametrize(
    "words",
    [np.zeros(100_000, np.int64), np.tile([*[0] * 2000, 1], 50), np.tile(np.random.default_rng(1).integers(0, 900, 9000), 9)],
    ids=["one word", "blocks", "long period"],
)
def test_long_texts_take_little_time(words):
    found = find_runs(words.astype(np.int64), np.zeros(len(words), np.int64))
    longest = found[found[:, 2].argmax()]
    assert longest[1:3].tolist() == [0, len(words)]


def test_strongest_is_exact_and_ties_go_to_the_first():
    assert strongest([]) is None
    assert strongest([(5, 8, 2), (0, 12, 3), (0, 16, 4)]) == (0, 12, 3)
    big = 10**15
    assert strongest([(0, 4 * big, big), (9, 4 * big + 1, big)]) == (9, 4 * big + 1, big)


def test_collapse_drops_a_word_that_any_run_repeats():
    words = [b"%d" % i for i in range(12)]
    assert collapse(words, [(0, 8, 2), (4, 6, 1)]) == [b"0", b"1", b"10", b"11"]


def test_whole_texts_with_every_odd_case(spark):
    long = " ".join(["a", "b"] * 60_000)
    rows = [
        (1, "x a b a b\ta b\na b y"), (1, "x a b a b\ta b\na b y"), (2, None), (3, ""), (4, " \t\n"), (None, "z z z z z z"), (5, long),
        (6, "a\u00a0a a\u00a0a a\u00a0a a\u00a0a a\u00a0a a\u00a0a"), (7, "no run at all here"),
    ]
    df = spark.createDataFrame(rows, SCHEMA).withColumn("runs", F.lit("a clash")).withColumn("collapsed", F.lit(1))
    got = {}
    for r in periodic_runs(df).collect():
        got.setdefault(r["doc_id"], []).append((r["n_words"], [tuple(x) for x in r["runs"]], r["collapsed"]))
    assert got[1] == [(10, [(1, 8, 2)], "x a b y")] * 2
    assert got[2] == got[3] == got[4] == [(0, [], "")]
    assert got[None] == [(6, [(0, 6, 1)], "z")]
    assert got[5] == [(120_000, [(0, 120_000, 2)], "a b")]
    assert got[6] == [(6, [(0, 6, 1)], "a\u00a0a")]
    assert got[7] == [(5, [], "no run at all here")]
    assert periodic_runs(df.limit(0)).collect() == []


def test_query_by_brute_force(spark, tmp_path):
    rnd = random.Random(3)
    rows = [(i, " ".join(str(w) for w in made_up(rnd)) or None) for i in range(400)]
    spark.createDataFrame(rows, SCHEMA).write.parquet(str(tmp_path / "documents.parquet"))
    got = {r["doc_id"]: r for r in queries.op11_periodic_runs(spark, str(tmp_path)).collect()}
    assert len(got) == 400
    edited = 0
    for doc_id, text in rows:
        words = (text or "").split()
        n, h = len(words), zlib.crc32(str(doc_id).encode())
        g = h // 10
        if h % 10 == 0 and n > 0:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
            edited += 1
        runs = plain_runs(words)
        dropped = {i for s, length, q in runs for i in range(s + q, s + length)}
        best = min(runs, key=lambda r: (-r[1] / r[2], r[0], r[2]), default=(None, None, None))
        row = got[doc_id]
        assert (row["n_runs"], row["start"], row["length"], row["period"]) == (len(runs), *best)
        assert row["exponent_milli"] == (1000 * best[1] // best[2] if runs else None)
        lines = "".join(f"{s},{length},{q}\n" for s, length, q in runs)
        kept = " ".join(w for i, w in enumerate(words) if i not in dropped)
        assert row["runs_sha256"] == hashlib.sha256(lines.encode()).hexdigest()
        assert row["collapsed_sha256"] == hashlib.sha256(kept.encode()).hexdigest()
    assert edited > 20
