from __future__ import annotations

import math
import random
import re
from collections import Counter, defaultdict

import corpus_pipeline
import public_tokenizers
import tiktoken
from conftest import SMALL
from pyspark.sql import functions as F

import __spark_entry__ as entry_point
from indexday.llm import bpe
from indexday.llm.common import prepared
from indexday.llm.langid import identify_with_folds


def test_stages_follow_each_other(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    columns = docs.columns
    found = {}
    for name, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, SMALL)
        found[name] = [r.asDict() for r in docs.collect()]
        if name != corpus_pipeline.STAGES[-1][0]:
            assert docs.columns == columns
        docs = spark.createDataFrame(found[name], docs.schema)

    source = spark.read.parquet(f"{SMALL}/documents.parquet")
    said = [r.asDict() for r in identify_with_folds(source, sized=True).collect()]
    least = {}
    for lang in {r["lang"] for r in said} - {None}:
        scores = [r["score"] for r in said if r["lang"] == r["lang_pred"] == lang and not r["held_out"] and r["n_grams"] >= 32]
        least[lang] = sorted(scores)[max(math.ceil(0.01 * len(scores)) - 1, 0)] / 2
    like = {
        r["doc_id"] for r in said
        if r["lang_pred"] != "und" and r["score"] > 0 and (r["n_grams"] < 32 or r["score"] >= least[r["lang_pred"]])
    }
    assert {r["doc_id"] for r in found["language"]} == like

    grams = lambda t: {tuple(w[i : i + 5]) for w in [t.lower().split()] for i in range(max(1, len(w) - 4))}
    sets = {r["doc_id"]: grams(r["text"]) for r in found["language"]}
    near = lambda a, b: len(a & b) >= 0.75 * len(a | b)
    kept = [r["doc_id"] for r in found["distinct"]]
    assert len(set(kept)) == len(kept)
    assert not any(near(sets[a], sets[b]) for a in kept for b in kept if a < b)
    for gone in sets.keys() - set(kept):
        assert any(near(sets[gone], sets[d]) for d in sets if d < gone)

    words = lambda t: re.findall(r"[^\x20\x09-\x0D]+", t or "")
    size = {r["doc_id"]: len(words(r["text"])) for r in found["distinct"]}
    taken = Counter()
    for r in found["mixture"]:
        taken[r["doc_id"]] += len(words(r["text"]))
        assert r["n_chars"] == len(r["text"])
    assert all(0 < n <= 2 * size[d] for d, n in taken.items())
    by_source = defaultdict(int)
    for r in found["mixture"]:
        by_source[r["source"]] += len(words(r["text"]))
    assert abs(sum(by_source.values()) - 1.5 * sum(size.values())) <= len(by_source)

    ranks = bpe.load_ranks(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))
    whole = tiktoken.Encoding("whole", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    want = sorted((r["doc_id"], whole.encode_ordinary(r["text"])) for r in found["mixture"])
    assert sorted((r["doc_id"], r["ids"]) for r in found["token_ids"]) == want


def test_run_writes_and_rereads(spark):
    assert "pipeline" in entry_point.queries()
    assert corpus_pipeline.run(spark, SMALL).columns == ["doc_id", "n_tokens", "ids"]


def test_stages_on_edge_cases(spark, frame):
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    empty = frame([], schema)
    rows = [(1, None, None, None, None), (2, "", "en", "a", 0), (3, "some words of text here", "en", "a", 23)]
    rows += [(3, "some words of text here", "en", "a", 23), (None, "other words", "fr", None, 11), (5, "123", "en", "b", 3)]
    odd = frame(rows, schema)
    for name, stage in corpus_pipeline.STAGES:
        assert stage(spark, empty, SMALL).collect() == [], name
        assert len(stage(spark, odd, SMALL).collect()) > 0, name
    assert sum(r.doc_id == 3 for r in corpus_pipeline.distinct(spark, odd, SMALL).collect()) == 1


SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def test_distinct_decides_per_row(spark, frame):
    """A text without copies stays whoever else has its id; of every class one row stays."""
    one, other, third = (" ".join(f"{x}{i}" for i in range(40)) for x in "abc")
    near = one.replace("a39", "other")
    rows = [(1, one), (2, one), (2, other), (3, near), (3, near), (4, third), (4, third), (4, third.upper()), (None, one), (5, None),
            (5, ""), (5, " "), (6, other + " more")]
    docs = frame([(i, t, None, None, 0) for i, t in rows], SCHEMA).withColumn("set_key", F.lit("clash")).withColumn("kept", F.lit(1))
    found = corpus_pipeline.distinct(spark, docs, SMALL)
    assert found.columns == docs.columns
    got = sorted(((r.doc_id, r.text) for r in found.collect()), key=str)
    assert got == sorted([(1, one), (2, other), (4, third.upper()), (None, one), (5, None)], key=str)


def test_language_rejects_what_is_unlike_every_language(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rnd = random.Random(1)
    letters = {"russian": "абвгдежзиклмнопрст", "greek": "αβγδεζηθικλμνοπρστ", "chinese": "的一是不了人我在有他这中大来上", "random": "abcdefghijklmnopqrstuvwxyz"}
    odd = []
    for i in range(80):
        own = letters[list(letters)[i % 4]]
        words = ["".join(rnd.choices(own, k=rnd.randint(3, 9))) for _ in range(rnd.randint(15, 300))]
        odd.append((1_000_000 + i, " ".join(words), None, None, 0))
    odd += [(2_000_000, None, "en", "a", 0), (2_000_001, "", "en", "a", 0), (2_000_002, "12 34 !", "en", "a", 0)]
    both = docs.select("doc_id", "text", "lang", "source", "n_chars").unionByName(spark.createDataFrame(odd, SCHEMA)).withColumn("score", F.lit("clash"))
    found = corpus_pipeline.language(spark, both, SMALL)
    assert found.columns == both.columns and found.filter("score <> 'clash'").isEmpty()
    kept = [r.doc_id for r in found.select("doc_id").collect()]
    assert not [d for d in kept if d >= 1_000_000]
    clean = spark.read.parquet("/root/testdata/sf0.01/labels.parquet").filter("quality = 1 AND toxic = 0")
    clean = [r.doc_id for r in clean.select("doc_id").collect()]
    assert len(set(clean) & set(kept)) >= 0.995 * len(set(clean)) > 0


def test_very_long_and_tied_texts(spark, frame):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").limit(60)
    long = " ".join(r.text for r in docs.collect()) * 20
    extra = [(900_001, long, "en", "a", len(long)), (900_002, long, "en", "a", len(long)), (900_003, long + " end", "en", None, len(long) + 4)]
    out = docs.unionByName(spark.createDataFrame(extra, SCHEMA))
    for name, stage in corpus_pipeline.STAGES:
        out = prepared(spark).put(name, stage(spark, out, SMALL))
        if name == "distinct":
            assert [r.doc_id for r in out.filter("doc_id >= 900000").collect()] == [900_001]
    assert out.columns == ["doc_id", "n_tokens", "ids"]
