"""Periodic runs of words, found through a Re-Pair grammar."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from indexday.llm.common import lean, prepared

MIN_LENGTH = 6
MIN_EXPONENT = 4
GROUP_BYTES = 2 * 1024 * 1024
MIX = np.uint64(0x9E3779B97F4A7C15)
NEVER = np.iinfo(np.int64).max

Run = tuple[int, int, int]  # start, length, period


def _at_most(*parts: np.ndarray) -> np.ndarray:
    """For each row of ``parts`` a count of equal rows, by hash: never too low."""
    hashed = np.zeros(len(parts[0]), np.uint64)
    for part in parts:
        hashed = (hashed ^ part.astype(np.uint64)) * MIX
        hashed ^= hashed >> np.uint64(29)
    bits = max(len(hashed).bit_length() + 2, 8)
    place = ((hashed * MIX) >> np.uint64(64 - bits)).astype(np.int64)
    return np.bincount(place, minlength=1 << bits)[place]


def stretches(ids: np.ndarray, doc: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(places, stretch number) of the words that may be in a run; a run never leaves its stretch.

    A run holds each of its words ``MIN_EXPONENT`` times and each pair of neighbours once less. Words and pairs that are rarer
    in their stretch cut it, over and over until none is left to cut.
    """
    at, part, here = np.arange(len(ids)), doc.astype(np.int64), ids
    while len(at):
        common = _at_most(part, here) >= MIN_EXPONENT
        linked = (part[1:] == part[:-1]) & common[1:] & common[:-1]
        linked &= _at_most(part[:-1], here[:-1], here[1:]) >= MIN_EXPONENT - 1
        before = int((part[1:] != part[:-1]).sum())
        part = np.concatenate([[0], np.cumsum(~linked)])
        keep = np.bincount(part)[part] >= MIN_LENGTH
        if keep.all() and int(part[-1]) == before:
            break
        at, part, here = at[keep], part[keep], here[keep]
    return at, part


class Grammar:
    """Rules X -> Y Z over the words of all stretches, each with the places in the text that X derives.

    Rules are made as Re-Pair makes them, from the most frequent pairs of neighbours; in one round a pair is
    replaced wherever neither pair that overlaps it is more frequent (of equal ones, a hash decides). A stretch without
    a repeated pair is folded by twos, so each ends as one symbol and every boundary between two words is the
    inner boundary of some rule.
    """

    def __init__(self, ids: np.ndarray, part: np.ndarray):
        _, symbols = np.unique(ids, return_inverse=True)
        self.sizes = np.ones(int(symbols.max()) + 1 if len(symbols) else 0, np.int64)
        self.words = len(self.sizes)
        self.splits = np.zeros(self.words, np.int64)
        self.first = np.zeros(self.words, np.int64)
        rules, places = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        known, named = np.zeros(0, np.int64), np.zeros(0, np.int64)
        at = np.arange(len(ids))
        while True:
            keys, chosen = self._choose(symbols, part)
            if not len(chosen):
                break
            pairs, own = np.unique(keys[chosen], return_inverse=True)
            slot = np.searchsorted(known, pairs)
            seen = (slot < len(known)) & (known[np.minimum(slot, max(len(known) - 1, 0))] == pairs if len(known) else False)
            names = np.empty(len(pairs), np.int64)
            names[seen] = named[slot[seen]]
            new = pairs[~seen]
            names[~seen] = len(self.sizes) + np.arange(len(new))
            left, right = self.sizes[new >> 32], self.sizes[new & 0xFFFFFFFF]
            first = np.empty(len(pairs), np.int64)
            first[own] = at[chosen]
            self.sizes = np.concatenate([self.sizes, left + right])
            self.splits = np.concatenate([self.splits, left])
            self.first = np.concatenate([self.first, first[~seen]])
            known, named = np.concatenate([known, new]), np.concatenate([named, names[~seen]])
            order = np.argsort(known)
            known, named = known[order], named[order]
            rules.append(names[own])
            places.append(at[chosen])
            symbols[chosen] = names[own]
            stay = np.ones(len(symbols), bool)
            stay[chosen + 1] = False
            symbols, part, at = symbols[stay], part[stay], at[stay]
        self.rules, self.places = np.concatenate(rules), np.concatenate(places)

    def derived(self, words: np.ndarray, rule: int) -> np.ndarray:
        """The words of a rule, read where it derives first."""
        return words[self.first[rule] : self.first[rule] + self.sizes[rule]]

    @staticmethod
    def _choose(symbols: np.ndarray, part: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(key of the pair at each place, places whose pair is replaced in this round)."""
        keys = (symbols[:-1] << 32) | symbols[1:]
        inside = np.flatnonzero(part[1:] == part[:-1])
        if not len(inside):
            return keys, inside
        pairs, place, counts = np.unique(keys[inside], return_inverse=True, return_counts=True)
        order = np.lexsort((pairs.astype(np.uint64) * MIX, -counts))
        rank = np.empty(len(pairs), np.int64)
        rank[order] = np.arange(len(pairs))
        repeated = counts[place] > 1
        owner = part[inside]
        busy = np.bincount(owner, weights=repeated, minlength=int(part[-1]) + 1) > 0
        ranks = np.full(len(symbols) + 1, NEVER)  # the last stands before the first and after the last
        ranks[inside] = np.where(repeated, rank[place], NEVER)
        own, before, after = ranks[:-1], np.concatenate([ranks[-1:], ranks[:-2]]), ranks[1:]
        number = np.arange(len(symbols))

        def odd(block_starts: np.ndarray) -> np.ndarray:
            """Whether a place is an odd number of places after the start of its block."""
            return (number - np.maximum.accumulate(np.where(block_starts, number, 0))) & 1 == 1

        best = (own < NEVER) & (own <= before) & (own <= after) & ~odd(own != before)
        folded = np.zeros(len(symbols), bool)
        folded[inside] = ~busy[owner]
        folded &= ~odd(np.concatenate([[True], part[1:] != part[:-1]]))
        return keys, np.flatnonzero(best | folded)


def _common(a: np.ndarray, b: np.ndarray) -> int:
    """Length of the longest common prefix."""
    most, at, step = min(len(a), len(b)), 0, 16
    while at < most:
        end = min(at + step, most)
        differ = a[at:end] != b[at:end]
        if differ.any():
            return at + int(differ.argmax())
        at, step = end, step * 4
    return most


def _self_overlaps(words: np.ndarray) -> list[int]:
    """For each place the length of the longest common prefix of the words from there and all words."""
    w, n = words.tolist(), len(words)
    out, left, right = [n] + [0] * (n - 1), 0, 0
    for i in range(1, n):
        k = min(right - i, out[i - left]) if i < right else 0
        while i + k < n and w[k] == w[i + k]:
            k += 1
        out[i] = k
        if i + k > right:
            left, right = i, i + k
    return out


def _squares(words: np.ndarray, most: int) -> list[tuple[int, int]]:
    """(q, reach) for each q up to ``most`` with a square of period q in front that has no smaller period.

    ``words[:reach]`` is the longest part with period q. Squares inside it are powers of the same root.
    """
    most = min(most, len(words) // 2)
    if most < 1:
        return []
    candidates = np.flatnonzero(words[1 : most + 1] == words[0]) + 1
    if len(candidates):
        candidates = candidates[(candidates == 1) | (words[candidates + 1 - (candidates == 1)] == words[1])]
    found, covered, work, overlaps = [], 0, 0, None
    for q in candidates.tolist():
        if 2 * q <= covered:
            continue
        if overlaps is not None:
            same = overlaps[q]
        else:
            same = _common(words, words[q:])
            work += same
            if work > 8 * len(words):  # many long overlaps: find all of them in linear time
                overlaps = _self_overlaps(words)
        if same >= q:
            covered = q + same
            found.append((q, covered))
    return found


def crossing(words: np.ndarray, split: int) -> set[Run]:
    """Runs of ``words`` over the boundary before ``split``, as far as they reach inside.

    A run has two periods on one side of the boundary or on the other, so its period is that of a square next to it.
    """
    found, most = set(), len(words) // MIN_EXPONENT
    left, right = words[:split][::-1], words[split:]
    for q, reach in _squares(right, most):
        back = _common(left, words[: split + q][::-1])
        if back + reach >= max(MIN_LENGTH, MIN_EXPONENT * q):
            found.add((split - back, back + reach, q))
    for q, reach in _squares(left, most):
        on = _common(right, words[split - q :])
        if on + reach >= max(MIN_LENGTH, MIN_EXPONENT * q):
            found.add((split - reach, on + reach, q))
    return found


def find_runs(ids: np.ndarray, doc: np.ndarray) -> np.ndarray:
    """Rows (doc, start in ``ids``, length, period) of all runs, by doc, start and period.

    The runs over a rule's boundary are sought once and moved to all places that the rule derives. The
    smallest derived part that holds a run holds it whole with the boundary inside, so what is found of it elsewhere is
    a part of that and goes when only maximal intervals of each period stay.
    """
    at, part = stretches(ids, doc)
    words = ids[at]
    grammar = Grammar(words, part)
    pieces = [
        (rule, *run)
        for rule in np.flatnonzero(grammar.sizes >= MIN_LENGTH).tolist()
        for run in crossing(grammar.derived(words, rule), int(grammar.splits[rule]))
    ]
    if not pieces:
        return np.zeros((0, 4), np.int64)
    rule, start, length, period = np.array(pieces, np.int64).T
    order = np.argsort(grammar.rules, kind="stable")
    rules, places = grammar.rules[order], grammar.places[order]
    low, high = np.searchsorted(rules, rule), np.searchsorted(rules, rule, "right")
    times = high - low
    offset = np.arange(times.sum()) - np.repeat(np.cumsum(times) - times, times)
    start = np.repeat(start, times) + places[np.repeat(low, times) + offset]
    length, period = np.repeat(length, times), np.repeat(period, times)
    order = np.lexsort((-length, start, period))
    start, length, period = start[order], length[order], period[order]
    new = np.concatenate([[True], period[1:] != period[:-1]])
    ends = (np.cumsum(new) << 40) + start + length
    widest = np.concatenate([[0], np.maximum.accumulate(ends)[:-1]])
    keep = ends > widest
    start, length, period = at[start[keep]], length[keep], period[keep]
    order = np.lexsort((period, start))
    return np.stack([doc[start], start, length, period], axis=1)[order]


def strongest(runs: list[Run]) -> Run | None:
    """The run of greatest length / period, compared exactly; of equal ones that of least start, then period."""
    best = None
    for run in sorted(runs, key=lambda r: (r[0], r[2])):
        if best is None or run[1] * best[2] > best[1] * run[2]:
            best = run
    return best


def collapse(words: list[bytes], runs: list[Run]) -> list[bytes]:
    """The words without those that a run holds after its first period."""
    if not runs:
        return words
    gone = np.zeros(len(words) + 1, np.int64)
    for start, length, period in runs:
        gone[start + period] += 1
        gone[start + length] -= 1
    return [words[i] for i in np.flatnonzero(np.cumsum(gone[:-1]) == 0).tolist()]


def _groups(texts: list[str]) -> Iterator[tuple[int, int]]:
    """Consecutive texts of about ``GROUP_BYTES``, or one longer text."""
    start = held = 0
    for i, text in enumerate(texts):
        if i > start and held + len(text) > GROUP_BYTES:
            yield start, i
            start, held = i, 0
        held += len(text)
    if start < len(texts):
        yield start, len(texts)


RUN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])
FOUND = "n_words long, runs array<struct<start:long,length:long,period:long>>, strongest struct<start:long,length:long,period:long>, collapsed string"


def _scan(edit: Callable[[int | None, list[bytes]], list[bytes]] | None):
    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [t or "" for t in batch.column("text").to_pylist()]
            names = batch.column("doc_id").to_pylist()
            for low, high in _groups(texts):
                # the six bytes that this splits at are those of the word pattern
                words = [t.encode("utf-8", "surrogatepass").split() for t in texts[low:high]]
                if edit is not None:
                    words = [edit(name, own) for name, own in zip(names[low:high], words, strict=True)]
                sizes = [len(own) for own in words]
                first = np.concatenate([[0], np.cumsum(sizes)])
                flat = pa.array([w for own in words for w in own], pa.binary()).dictionary_encode()
                ids = flat.indices.to_numpy(zero_copy_only=False).astype(np.int64)
                found = [[] for _ in words]
                for doc, start, length, period in find_runs(ids, np.repeat(np.arange(len(words)), sizes)).tolist():
                    found[doc].append((start - int(first[doc]), length, period))
                left = [b" ".join(collapse(own, runs)) for own, runs in zip(words, found, strict=True)]
                as_rows = [[dict(zip(("start", "length", "period"), r, strict=True)) for r in runs] for runs in found]
                best = [dict(zip(("start", "length", "period"), b, strict=True)) if (b := strongest(runs)) else None for runs in found]
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").slice(low, high - low), pa.array(sizes, pa.int64()),
                     pa.array(as_rows, pa.list_(RUN)), pa.array(best, RUN), pa.array(left, pa.string())],
                    ["doc_id", "n_words", "runs", "strongest", "collapsed"],
                )

    return scan


def periodic_runs(
    docs: DataFrame, edit: Callable[[int | None, list[bytes]], list[bytes]] | None = None
) -> DataFrame:
    """The periodic runs of words of each whole text, and the text without their repetitions.

    Words are ``[^\\x20\\x09-\\x0D]+``, numbered from 0. A run is a stretch with smallest period q of at least
    ``max(6, 4 * q)`` words that no neighbour extends. ``edit`` may replace a document's words before the search.
    Returns ``doc_id``, ``n_words``, ``runs`` (start, length, period; by start, then period), ``strongest`` (the run of greatest length / period;
    ties: least start, then period) and ``collapsed``: the words that no run holds after its first q words, between single
    spaces.

    A text is searched in one piece, texts of about 2 MB together with one grammar; nothing is shuffled. Null texts and
    texts without words have no runs, a null ``strongest`` and an empty ``collapsed``. Repeated rows and null ids
    are answered each. An empty table gives no rows. Other columns are not read.
    """
    prepared(docs.sparkSession)
    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(lean(_scan(edit)), f"doc_id {kind}, {FOUND}")
