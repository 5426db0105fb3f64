"""Language identification with hyperdimensional profiles."""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from indexday.llm.common import free_name, lean, prepared

UNKNOWN = "und"
ANSWER = ("lang_pred", "score", "n_grams")
SPACE = 32
CODE_BITS = 21
DENSE_CODES = 1 << 22


@lru_cache(maxsize=1)
def _letters() -> np.ndarray:
    """For each code point: its letter, or the space that stands for everything else."""
    table = np.full(0x110000, SPACE, np.int64)
    for code in range(0x110000):
        if chr(code).isalpha():
            table[code] = code
    return table


def _trigrams(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(text number, trigram) for all trigrams of letters and single spaces of the lower-cased texts.

    Every text stands between spaces; a trigram is its three code points in one long.
    """
    joined = [f" {t.lower()} " for t in texts]
    sizes = np.array([len(t) for t in joined])
    codes = np.frombuffer("".join(joined).encode("utf-32-le", "surrogatepass"), np.uint32)
    codes = _letters()[codes]
    owner = np.repeat(np.arange(len(texts)), sizes)
    new = np.r_[True, (codes[1:] != SPACE) | (codes[:-1] != SPACE) | (owner[1:] != owner[:-1])]
    codes, owner = codes[new], owner[new]
    if len(codes) < 3:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    grams = (codes[:-2] << (2 * CODE_BITS)) | (codes[1:-1] << CODE_BITS) | codes[2:]
    whole = (owner[:-2] == owner[2:]) & (codes[1:-1] != SPACE)
    return owner[:-2][whole], grams[whole]


def _numbered(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(distinct values, place of each value among them)."""
    letters, places = np.unique(values & ((1 << CODE_BITS) - 1)), []
    letters = np.union1d(letters, np.unique(values >> (2 * CODE_BITS)))
    letters = np.union1d(letters, np.unique((values >> CODE_BITS) & ((1 << CODE_BITS) - 1)))
    if len(letters) ** 3 > DENSE_CODES:
        return np.unique(values, return_inverse=True)
    places = np.zeros(int(letters[-1]) + 1, np.int64)
    places[letters] = np.arange(len(letters))
    n, low = len(letters), (1 << CODE_BITS) - 1
    short = (places[values >> (2 * CODE_BITS)] * n + places[(values >> CODE_BITS) & low]) * n + places[values & low]
    there = np.flatnonzero(np.bincount(short, minlength=n**3))
    dense = np.zeros(n**3, np.int64)
    dense[there] = np.arange(len(there))
    names = (letters[there // (n * n)] << (2 * CODE_BITS)) | (letters[there // n % n] << CODE_BITS) | letters[there % n]
    return names, dense[short]


class Profiles:
    """Random letter vectors of +1 and -1, and the n-gram vectors bound from them."""

    KEPT = 30_000

    def __init__(self, dimensions: int, seed: int):
        self.dimensions, self.seed = dimensions, seed
        self._letter: dict[int, np.ndarray] = {}
        self._row: dict[int, int] = {}
        self._vectors: np.ndarray | None = None  # made in the task, not sent to it

    def letter(self, code: int) -> np.ndarray:
        if code not in self._letter:
            if len(self._letter) > self.KEPT:
                self._letter.clear()
            bits = np.random.default_rng([self.seed, code]).integers(0, 2, self.dimensions)
            self._letter[code] = (2 * bits - 1).astype(np.int8)
        return self._letter[code]

    def ngram(self, code: int) -> np.ndarray:
        """The letters' vectors, permuted by their place, multiplied."""
        low = (1 << CODE_BITS) - 1
        a, b, c = code >> (2 * CODE_BITS), (code >> CODE_BITS) & low, code & low
        return np.roll(self.letter(a), 2) * np.roll(self.letter(b), 1) * self.letter(c)

    def bundle(self, owner: np.ndarray, grams: np.ndarray, n: int) -> np.ndarray:
        """For each of n texts the sum of its n-gram vectors. Vectors are kept from one batch to the next."""
        out = np.zeros((n, self.dimensions), np.float32)
        if not len(grams):
            return out
        if self._vectors is None:
            self._vectors = np.empty((self.KEPT, self.dimensions), np.int8)
        names, place = _numbered(grams)
        if len(names) > self.KEPT:
            return self._in_pieces(owner, names, place, out)
        if len(self._row) + len(names) > self.KEPT:
            self._row.clear()
        at = np.empty(len(names), np.int64)
        for i, code in enumerate(names.tolist()):
            row = self._row.get(code)
            if row is None:
                row = self._row[code] = len(self._row)
                self._vectors[row] = self.ngram(code)
            at[i] = row
        starts = np.searchsorted(owner, np.arange(n + 1))
        for i in range(n):
            own = place[starts[i] : starts[i + 1]]
            if len(own):
                counts = np.bincount(own)
                there = np.flatnonzero(counts)
                out[i] = counts[there].astype(np.float32) @ self._vectors[at[there]].astype(np.float32)
        return out

    def _in_pieces(self, owner, names, place, out):
        for start in range(0, len(names), self.KEPT):
            here = (place >= start) & (place < start + self.KEPT)
            vectors = np.stack([self.ngram(c) for c in names[start : start + self.KEPT].tolist()])
            pairs, counts = np.unique(owner[here] * self.KEPT + (place[here] - start), return_counts=True)
            for i in np.unique(pairs // self.KEPT):
                own = pairs // self.KEPT == i
                out[i] += counts[own].astype(np.float32) @ vectors[pairs[own] % self.KEPT].astype(np.float32)
        return out


def _learn(profiles: Profiles):
    def bundle(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[str, np.ndarray] = {}
        for batch in batches:
            names = batch.column("lang").to_pylist()
            order = sorted(set(names))
            place = {x: i for i, x in enumerate(order)}
            owner, grams = _trigrams(batch.column("text").to_pylist())
            if not len(grams):
                continue
            lang = np.array([place[x] for x in names])[owner]
            by_lang = np.argsort(lang, kind="stable")
            found = profiles.bundle(lang[by_lang], grams[by_lang], len(order))
            for name, vector in zip(order, found, strict=True):
                sums[name] = sums.get(name, 0) + vector.astype(np.float64)
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(sums), pa.string()), pa.array([v.tolist() for v in sums.values()], pa.list_(pa.float64()))],
            ["lang", "profile"],
        )

    return bundle


def _predict(profiles: Profiles, names: list[str], prototypes: np.ndarray, columns: list[str], sized: bool):
    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [t or "" for t in batch.column(columns.index("text")).to_pylist()]
            owner, grams = _trigrams(texts)
            own = profiles.bundle(owner, grams, len(texts)).astype(np.float64)
            has_letters = np.bincount(owner, minlength=len(texts)) > 0
            norms = np.linalg.norm(own, axis=1)
            if names:
                cosines = own @ prototypes.T / np.where(norms > 0, norms, 1)[:, None]
                best = cosines.argmax(axis=1)
                value = np.clip(cosines[np.arange(len(texts)), best], 0, 1)
                said = [names[i] if ok else UNKNOWN for i, ok in zip(best, has_letters, strict=True)]
                value = np.where(has_letters, value, 0.0)
            else:
                said, value = [UNKNOWN] * len(texts), np.zeros(len(texts))
            found = [pa.array(said, pa.string()), pa.array(value, pa.float64())]
            if sized:
                found.append(pa.array(np.bincount(owner, minlength=len(texts))))
            yield pa.RecordBatch.from_arrays([*batch.columns, *found], [*batch.schema.names, *ANSWER[: len(found)]])

    return score


def held_out(doc_id: str = "doc_id") -> Column:
    """The fold that is never learned from; rows without id are in neither fold."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 4 == 2, F.lit(False))


def least_scores(named: DataFrame, least_grams: int, quantile: float, part: float) -> DataFrame:
    """(lang_pred, least): for each language the score below which a text is unlike it, learned from labelled texts.

    ``named`` is what :func:`identify_with_folds` gives, ``sized``, with ``lang``. It is ``part`` of the low ``quantile`` of the scores
    of the learning documents that hold at least ``least_grams`` trigrams and are named as they are labelled. One line
    per language.
    """
    learned = named.filter(~held_out() & (F.col("lang") == F.col("lang_pred")) & (F.col("n_grams") >= least_grams))
    return learned.groupBy("lang_pred").agg((F.percentile_approx("score", quantile, 10_000) * part).alias("least"))


def prototypes(examples: DataFrame, dimensions: int = 1024, seed: int = 9) -> tuple[list[str], np.ndarray]:
    """Language names and their unit profiles, from all rows of (text, lang).

    Each task bundles the n-gram vectors of its texts by language; the sums are added by language and
    dimension. What reaches the driver is one vector per language.
    """
    prepared(examples.sparkSession)
    usable = examples.filter(F.col("text").isNotNull() & F.col("lang").isNotNull())
    partial = usable.select("text", F.col("lang").cast("string").alias("lang")).mapInArrow(
        lean(_learn(Profiles(dimensions, seed))), "lang string, profile array<double>"
    )
    sums = (
        partial.select("lang", F.posexplode("profile").alias("at", "value"))
        .groupBy("lang", "at").agg(F.sum("value").alias("value"))
        .groupBy("lang").agg(F.transform(F.sort_array(F.collect_list(F.struct("at", "value"))), lambda x: x["value"]).alias("profile"))
    )
    rows = sorted(sums.collect(), key=lambda r: r["lang"])
    vectors = np.array([r["profile"] for r in rows], np.float64).reshape(len(rows), dimensions)
    norms = np.linalg.norm(vectors, axis=1, keepdims=True)
    keep = norms[:, 0] > 0
    return [r["lang"] for r, ok in zip(rows, keep, strict=True) if ok], (vectors / np.where(norms > 0, norms, 1))[keep]


def identify(
    docs: DataFrame, examples: DataFrame, dimensions: int = 1024, seed: int = 9, sized: bool = False
) -> DataFrame:
    """``docs`` with ``lang_pred`` and ``score``, the cosine with the nearest prototype; ``sized`` adds ``n_grams``, the trigrams of the text.

    Texts are lower-cased, runs of anything but letters are one space, and the trigrams around a letter are
    bound from random letter vectors: permuted by place, multiplied, and bundled (added) per document.
    Prototypes are learned from ``examples``, a frame with ``text`` and ``lang``; predictions read ``text`` only.

    Null texts, empty texts and texts without letters give ``und`` and 0, as does everything when there is
    nothing to learn from. Equal cosines go to the first language by code point. Repeated rows are answered
    each; all columns of ``docs`` stay (one named lang_pred or score is replaced).
    """
    prepared(docs.sparkSession)
    names, vectors = prototypes(examples, dimensions, seed)
    answer = ANSWER if sized else ANSWER[:2]
    docs = docs.drop(*answer)
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema.fields)
    found = ", lang_pred string, score double" + (", n_grams long" if sized else "")
    return docs.mapInArrow(lean(_predict(Profiles(dimensions, seed), names, vectors, docs.columns, sized)), schema + found)


def identify_with_folds(docs: DataFrame, dimensions: int = 1024, seed: int = 9, sized: bool = False) -> DataFrame:
    """:func:`identify`, learned from the labelled documents outside the held-out fold."""
    fold = free_name(docs, "held_out") if "held_out" in docs.columns else "held_out"
    learn = docs.filter(F.col("doc_id").isNotNull() & ~held_out()).select("text", "lang")
    return identify(docs, learn, dimensions, seed, sized).withColumn(fold, held_out())
