"""Operator 1: substring dedup over sliding sentence spans.

Method: texts are cut into sentences; every run of several consecutive
sentences (the shortest from each sentence on that has MIN_UNITS units and
MIN_WORDS words, and the one that closes the text) is hashed, runs meet globally
by hash, and a sentence is removed when a run that covers it occurred before:
the first occurrence, by (doc_id, place), stays, all others go, within a document
too.

A passage is to be found wherever it starts, so a sentence of more than WINDOW
words is cut further, at places that the nearby words alone decide: the least
word hash of every WINDOW words inside the sentence. No unit is then longer than
WINDOW words, and any two texts that share 4 * WINDOW + MIN_WORDS - 3 words (49)
share a whole run. Words are compared in small letters (A-Z) without the
punctuation around them.

The runs are many, so they move little: a run that repeats inside its document
is settled there; of the others, a document's distinct hashes alone are grouped
with their least and largest doc_id (map-side first), and only hashes of several
documents are joined back. A hot run (one passage in a third of all rows) is one
row of that table, and the join splits its other side. Texts move only where
something is cut out of them: the ids of those documents are broadcast up to
FEW_IDS rows of one id, else joined.

Defined results: null and empty texts have no units and stay as they are; rows
that repeat a doc_id are one document, between which no copies are looked for
(a null doc_id is one as well, and sorts first); a text shorter than a run is
never touched; an empty table gives an empty result; the caller's columns travel
in one struct, so none can clash.
"""

from __future__ import annotations

import re

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from relcheck.llm.shared import WordHashes, arrow_pass, mix64, staged, whole

MIN_UNITS, MIN_WORDS, WINDOW = 3, 16, 9
FEW_IDS = 1_000_000
#: What ends a sentence, and what is stripped from words.
ENDS = frozenset(b".!?")
EDGE = b".!?;:,\"'()[]"
WORDS = re.compile(rb"[^\x20\x09-\x0D]+")
LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))


def units(text: bytes, hashes: WordHashes) -> tuple[np.ndarray, np.ndarray]:
    """(index of the first word of every unit, hashes of all words)."""
    low = text.translate(LOWER)
    words = low.split()
    n = len(words)
    if not n:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    h = hashes.of([w.strip(EDGE) for w in words])
    ends = np.fromiter((w[-1] in ENDS for w in words), bool, n)
    if b"\n" in low:
        counts = np.fromiter((len(x.split()) for x in low.split(b"\n")), np.int64)
        ends[np.cumsum(counts)[counts > 0] - 1] = True
    ends[-1] = True
    if n > WINDOW:  # the last word of a window may end a sentence, the others may not
        before = np.concatenate([[0], np.cumsum(ends)])
        at = np.flatnonzero(before[WINDOW - 1:n] == before[:n - WINDOW + 1])
        if len(at):
            seen = np.lib.stride_tricks.sliding_window_view(mix64(h.copy()), WINDOW)[at]
            ends[at + seen.argmin(axis=1)] = True
    return np.concatenate([[0], np.flatnonzero(ends[:-1]) + 1]), h


def runs(first: np.ndarray, words: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(hash, first unit, unit after the last) of every run, by first unit; the
    last may be one that closes the text where no other does."""
    n = len(first)
    bounds = np.concatenate([first, [len(words)]])
    on = np.maximum(np.searchsorted(bounds, first + MIN_WORDS), np.arange(n) + MIN_UNITS)
    start = np.flatnonzero(on <= n)
    after = on[start]
    if len(start) and after[-1] < n:
        start, after = np.append(start, start[-1]), np.append(after, n)
    # the hash of a run: sum of word hashes times powers of an odd base, by prefix sums modulo 2**64
    powers, inverse = _powers(len(words))
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(words * powers, dtype=np.uint64)])
    a, b = bounds[start], bounds[after]
    body = (sums[b] - sums[a]) * inverse[a]
    return mix64(body + (b - a).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)).view(np.int64), start, after


BASE = 0x5851F42D4C957F2D
_held = (np.ones(1, np.uint64), np.ones(1, np.uint64))


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of BASE and of its inverse modulo 2**64, at least n + 1 of them."""
    global _held
    if len(_held[0]) <= n:
        size = 1 << (n + 1).bit_length()
        base = np.full(size, BASE, np.uint64)
        back = np.full(size, pow(BASE, -1, 1 << 64), np.uint64)
        base[0] = back[0] = 1
        _held = (np.cumprod(base, dtype=np.uint64), np.cumprod(back, dtype=np.uint64))
    return _held[0][:n], _held[1][:n + 1]


def cut(text: bytes, gone: set[int], first: np.ndarray, n_words: int) -> bytes:
    """The text without the units in ``gone``: words and the white space before
    them go together; what is left keeps its own white space."""
    places = [m.span() for m in WORDS.finditer(text)]
    bounds = [*first.tolist(), n_words]
    left, at = [], 0
    for u in range(len(first)):
        end = places[bounds[u + 1] - 1][1]
        if u not in gone:
            left.append(text[at:end])
        at = end
    left.append(text[at:])
    return b"".join(left).lstrip() if 0 in gone else b"".join(left)


def all_runs(docs: DataFrame, text: str, key: str) -> DataFrame:
    """(id, h array<long>, again boolean): the distinct hashes of a text's runs,
    and whether any repeats inside the text."""
    def work():
        hashes = WordHashes()

        def do(texts, _):
            distinct, again = [], []
            for t in texts:
                first, words = units(t, hashes)
                h = runs(first, words)[0] if len(first) else np.zeros(0, np.int64)
                distinct.append(np.unique(h))
                again.append(len(distinct[-1]) < len(h))
            return [distinct, again]
        return do

    return arrow_pass(whole(docs, text, id=document(docs, key)).select("id", "body"), "h array<long>, again boolean", work, keep=["id"])


def document(docs: DataFrame, key: str) -> Column:
    """The id, null as the value that sorts first."""
    least = F.lit("") if docs.schema[key].dataType == T.StringType() else F.lit(-(1 << 63))
    return F.coalesce(F.col(f"`{key}`"), least)


def removals(docs: DataFrame, text: str, key: str) -> DataFrame:
    """(id, later array<long>): documents that lose something, with the hashes
    of runs that an earlier document has. No row is larger than its document."""
    found = staged(all_runs(docs, text, key), "runs")
    spans = found.select("id", F.explode("h").alias("h"))
    shared = staged(spans.groupBy("h").agg(F.min("id").alias("first"), F.max("id").alias("last")).where("first != last").select("h", "first"), "shared")
    later = spans.join(shared, "h").where("id != first").select("id", "h")
    own = found.where("again").select("id", F.lit(None).cast("long").alias("h"))
    return staged(later.unionByName(own).groupBy("id").agg(F.collect_set("h").alias("later")), "removals")  # nulls are left out


def cleaned(text: bytes, later: list[int], hashes: WordHashes) -> tuple[bytes, list[int], int]:
    """(clean text, removed units, removed words) of one text."""
    first, words = units(text, hashes)
    if not len(first):
        return text, [], 0
    seen, drop = set(later), set()
    for h, a, b in zip(*(x.tolist() for x in runs(first, words)), strict=True):
        if h in seen:
            drop.update(range(a, b))
        seen.add(h)
    bounds = [*first.tolist(), len(words)]
    return cut(text, drop, first, len(words)), sorted(drop), sum(bounds[u + 1] - bounds[u] for u in drop)


def substring_dedup(docs: DataFrame, text: str = "text", key: str = "doc_id", carry: list[str] | None = None) -> DataFrame:
    """(row, clean string, removed array<int>, n_words_removed long): ``row`` has
    the caller's columns (or those in ``carry``), ``clean`` the text without
    later copies (null: empty), ``removed`` the units that went, from 0."""
    gone = removals(docs, text, key).withColumnRenamed("id", "of")
    ids = gone.select("of")
    if ids.count() <= FEW_IDS:
        ids = F.broadcast(ids)
    body = whole(docs, text, carry, id=document(docs, key))
    none = F.array().cast("array<int>")
    kept = body.join(ids, F.col("id") == F.col("of"), "left_anti").select(
        "row", F.col("body").cast("string").alias("clean"), none.alias("removed"), F.lit(0).cast("long").alias("n_words_removed"))

    def work():
        hashes = WordHashes()

        def do(texts, rows):
            out = [cleaned(t, later, hashes) for t, later in zip(texts, rows.column("later").to_pylist(), strict=True)]
            return [[t.decode("utf-8", "replace") for t, _, _ in out], [r for _, r, _ in out], [n for _, _, n in out]]
        return do

    touched = body.join(ids, F.col("id") == F.col("of"), "left_semi").join(gone, F.col("id") == F.col("of")).select("row", "body", "later")
    return kept.unionByName(arrow_pass(touched, "clean string, removed array<int>, n_words_removed long", work, keep=["row"]))
