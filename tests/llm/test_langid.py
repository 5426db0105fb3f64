from __future__ import annotations

import zlib

import numpy as np
import pytest
from conftest import SMALL

from indexday.llm import langid
from indexday.llm.langid import Profiles, identify, identify_with_folds
from indexday.llm.queries import op9_language_id

ENGLISH = "the cat and the dog went through the garden with the other animals"
FRENCH = "le chat et le chien sont dans le jardin avec les autres animaux"


def test_edge_cases(frame):
    examples = frame([(ENGLISH, "en"), (FRENCH, "fr"), (None, "en"), ("no label", None), ("", "de")], "text string, lang string")
    docs = frame(
        [(1, "the other dog"), (2, "les autres chiens"), (3, None), (4, ""), (5, "123 !?"), (6, "the other dog"), (7, FRENCH * 3000)],
        "doc_id long, text string",
    ).selectExpr("*", "'kept' AS extra", "0 AS score")
    found = {r.doc_id: r for r in identify(docs, examples).collect()}
    assert [found[i].lang_pred for i in range(1, 8)] == ["en", "fr", "und", "und", "und", "en", "fr"]
    assert all(found[i].score == 0 for i in (3, 4, 5)) and found[7].score > 0.9
    assert found[1].score == pytest.approx(found[6].score) and found[1].extra == "kept"


def test_nothing_to_learn_and_empty(frame):
    docs = frame([(1, "text")], "doc_id long, text string")
    assert [(r.lang_pred, r.score) for r in identify(docs, frame([], "text string, lang string")).collect()] == [("und", 0.0)]
    assert identify(docs.limit(0), frame([(ENGLISH, "en")], "text string, lang string")).collect() == []


def test_fold_is_never_learned_from(frame):
    rows = [(i, FRENCH if zlib.crc32(str(i).encode()) % 4 == 2 else ENGLISH, "x") for i in range(20)]
    found = identify_with_folds(frame(rows, "doc_id long, text string, lang string"), 64).collect()
    assert {r.lang_pred for r in found} == {"x"}
    for r in found:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2)
        assert (r.score > 0.99) == (not r.held_out)


@pytest.mark.parametrize("kept", [Profiles.KEPT, 7])
def test_bundle_is_the_sum_of_bound_vectors(monkeypatch, kept):
    monkeypatch.setattr(Profiles, "KEPT", kept)
    profiles = Profiles(32, 1)
    owner, grams = langid._trigrams(["Ab, ba!", "", "xyz xyz"])
    found = profiles.bundle(owner, grams, 3)
    for i, text in enumerate([" ab ba ", "", " xyz xyz "]):
        want = np.zeros(32)
        for a, b, c in zip(text, text[1:], text[2:], strict=False):
            if b != " ":
                want += np.roll(profiles.letter(ord(a)), 2) * np.roll(profiles.letter(ord(b)), 1) * profiles.letter(ord(c))
        assert np.array_equal(found[i], want)


def test_held_out_accuracy(spark):
    found = op9_language_id(spark, SMALL).join(spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "lang"), "doc_id")
    held = [r for r in found.collect() if r.held_out]
    assert sum(r.lang == r.lang_pred for r in held) >= 0.98 * len(held) > 0
