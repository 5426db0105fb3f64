from __future__ import annotations

import random
import re

import numpy as np
from conftest import SMALL
from pyspark.sql import functions as F

from indexday.llm import ngram_join
from indexday.llm.ngram_join import divide_skip, near_duplicates, shingle_sets
from indexday.llm.queries import op10_ngram_jaccard


def grams(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if len(words) < 5:
        return frozenset([tuple(words)]) if words else frozenset()
    return frozenset(tuple(words[i : i + 5]) for i in range(len(words) - 4))


def brute(docs):
    sets = [grams(t) for _, t in docs]
    parent = list(range(len(docs)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in range(len(docs)):
        for b in range(a):
            both = len(sets[a] & sets[b])
            if both and None not in (docs[a][0], docs[b][0]) and 100 * both >= 75 * (len(sets[a]) + len(sets[b]) - both):
                parent[root(a)] = root(b)
    least = {}
    for at, (i, _) in enumerate(docs):
        if i is not None:
            least[root(at)] = min(i, least.get(root(at), i))
    return sorted((str(i), len(sets[at]), str(least[root(at)] if i is not None else None)) for at, (i, _) in enumerate(docs))


def check(df, docs):
    found = near_duplicates(df).collect()
    assert sorted((str(r.doc_id), r.n_shingles, str(r.component_id)) for r in found) == brute(docs)


def near_copies():
    rng = random.Random(4)
    words = [f"w{i}" for i in range(4000)]
    docs = []
    for family in range(12):
        base = rng.choices(words, k=rng.randint(3, 90))
        for copy in range(rng.randint(1, 14)):
            own = list(base)
            for _ in range(rng.randint(0, 4)):
                own[rng.randrange(len(own))] = rng.choice(words)
            docs.append((family * 100 + copy, " ".join(own[: len(own) - rng.randint(0, 3)])))
    passage = " ".join(rng.choices(words, k=60))
    docs += [(5000 + i, passage + " " + " ".join(rng.choices(words, k=i * 3))) for i in range(25)]
    return docs


def test_against_brute_force(frame, monkeypatch):
    monkeypatch.setattr(ngram_join, "BLOCK_WEIGHT", 3000)
    docs = near_copies()
    check(frame([(*d, 1) for d in docs], "doc_id long, text string, n_shingles int").repartition(5), docs)


def chain(n):
    """Texts of two passages each, both shared with a neighbour: one group, no links but those of a near copy."""
    passages = [" ".join(f"p{i}w{j}" for j in range(30)) for i in range(n + 1)]
    docs = [(i, f"{passages[i]} {passages[i + 1]}") for i in range(n)]
    return [*docs, (n, docs[n // 2][1] + " more"), (n + 1, docs[1][1] + " more")]


def test_a_chain_is_one_group_of_many_blocks(frame, monkeypatch):
    monkeypatch.setattr(ngram_join, "BLOCK_WEIGHT", 5000)
    docs = chain(150)
    check(frame(docs, "doc_id long, text string").repartition(4), docs)


def test_work_in_a_chain_grows_in_proportion(frame, monkeypatch):
    seats, inner = [], ngram_join._seats

    def counted(place, rare):
        found = inner(place, rare)
        blocks = place.agg(F.count_distinct("group", "block")).first()[0]
        seats.append((found.count() / place.count(), blocks))
        return found

    monkeypatch.setattr(ngram_join, "_seats", counted)
    monkeypatch.setattr(ngram_join, "BLOCK_WEIGHT", 20_000)
    for n in (500, 2000):
        found = near_duplicates(frame(chain(n), "doc_id long, text string"))
        assert found.filter("doc_id <> component_id").count() == 2
    (few, blocks), (many, more) = seats
    # a seat in its own block and one for each neighbour, however many blocks the group has
    assert more > 3 * blocks
    assert few < 3.1 and many < 3.1


def test_edge_cases(frame):
    docs = [(1, None), (2, ""), (3, " \t\n"), (4, "Three small WORDS"), (5, "three\tsmall words"), (6, "three small words more five six")]
    docs += [(7, "a b c d e"), (7, "a b c d e"), (8, "A B C D E"), (None, "a b c d e"), (9, "\xc0 b c d e"), (10, "\xe0 b c d e")]
    docs += [(11, "x " * 300_000), (12, "x " * 10), (13, "y" * 2_500_000 + " tail"), (14, "y" * 2_500_000 + " tail")]
    check(frame(docs, "doc_id long, text string"), docs)


def test_empty(frame):
    assert near_duplicates(frame([], "doc_id long, text string")).collect() == []
    lone = near_duplicates(frame([(1, "one two three four five")], "doc_id long, text string")).collect()
    assert [tuple(r) for r in lone] == [(1, 1, 1)]


def test_shingles_do_not_depend_on_segments(monkeypatch):
    texts = [t for _, t in near_copies()[:40]] + [None, "", "one", "long " * 3000]
    whole = [s.tolist() for s in shingle_sets(texts)]
    monkeypatch.setattr(ngram_join, "SEGMENT", 50)
    assert [s.tolist() for s in shingle_sets(texts)] == whole
    assert [len(s) for s in whole] == [len(grams(t)) for t in texts]


def test_divide_skip_finds_every_component():
    rng = np.random.default_rng(8)
    for _ in range(30):
        base = rng.choice(300, 60, replace=False)
        sets = []
        for _ in range(20):
            own = base[rng.random(60) > rng.choice([0.02, 0.1, 0.3])]
            sets.append(np.unique(np.append(own, rng.integers(300, 400, rng.integers(0, 10)))).astype(np.uint64))
        sets.sort(key=len)
        links = divide_skip(sets)
        part = list(range(20))
        for x, y in links:
            both = len(np.intersect1d(sets[x], sets[y]))
            assert 100 * both >= 75 * (len(sets[x]) + len(sets[y]) - both)
            part = [part[x] if p == part[y] else p for p in part]
        for x in range(20):
            for y in range(x):
                both = len(np.intersect1d(sets[x], sets[y]))
                if 100 * both >= 75 * (len(sets[x]) + len(sets[y]) - both):
                    assert part[x] == part[y]


def test_frequent_ids_are_sent_on(frame, monkeypatch):
    monkeypatch.setattr(ngram_join, "DF_TOP", 3)
    monkeypatch.setattr(ngram_join, "HELD_POSTINGS", 40)
    docs = near_copies()
    check(frame(docs, "doc_id long, text string").repartition(6), docs)


def test_query(spark):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()]
    found = op10_ngram_jaccard(spark, SMALL).collect()
    assert sorted((str(r.doc_id), r.n_shingles, str(r.component_id)) for r in found) == brute(docs)
