"""Operator 2: tokens of every whole text, counted where the text lies.

Method: two-tier lookup in the map task. Tier one is a compact table of the
lengths (in tokens) of the corpus's frequent pre-tokens, broadcast once; tier two
encodes a pre-token that is not in it and keeps the length in the worker's own
bounded cache. No pre-token of a text is ever shuffled. What is frequent is
counted over the whole corpus before: each task keeps a summary of HELD words (a
word more often than one in HELD of a task's words is surely in it), and of the
summed summaries the FREQUENT most frequent words come to the driver, which cuts
them into pre-tokens and measures those. So the broadcast is bounded by FREQUENT,
and the table only ever saves time: counts do not depend on it.

A text with characters on whose class two libraries may differ is cut at single
spaces between plain characters; the pieces that hold such characters are encoded
by the tokenizer itself (through the cache), the others as ever.

Defined results: null text counts as empty (0 bytes, 0 tokens); repeated rows
are counted each; an empty table gives an empty result; the caller's columns
are never looked at but for the id and the text, so none can clash.
"""

from __future__ import annotations

import heapq
import json
from collections import Counter
from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from relcheck.llm.shared import arrow_pass, by_slices, whole

#: The byte-level pre-token pattern that the vocabulary's
#: pre-tokenizer states (its use_regex).
PRE_TOKEN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: Characters on whose class two regular-expression libraries may differ
#: (controls, separators, marks beside the common ranges).
USUAL = r"\x21-\x7E¡-ſ‐-‧€"
UNUSUAL = regex.compile(rf"[^\t\n\r\x20{USUAL}]")
#: A single space between two plain characters always begins a pre-token.
SAFE = regex.compile(rf"(?<=[{USUAL}])(?= [{USUAL}])")
#: Entries of the worker's cache, and the longest pre-token it keeps.
CACHE_ENTRIES, CACHE_CHARS = 300_000, 48
#: Words of a task's summary, and of the table that is broadcast.
HELD, FREQUENT = 50_000, 65_536


def trimmed(counts: Counter, held: int) -> Counter:
    """The summary of Misra and Gries: the most frequent ``held`` words, all
    less the count of the first that is left out."""
    if len(counts) <= held:
        return counts
    top = heapq.nlargest(held + 1, counts.items(), key=lambda x: x[1])
    less = top[-1][1]
    return Counter({w: n - less for w, n in top if n > less})


def frequent_words(docs: DataFrame, text: str = "text", held: int = HELD, most: int = FREQUENT) -> list[str]:
    """The corpus's most frequent words (between white space), most frequent
    first. A task sends a summary, not its words."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter = Counter()
        for batch in batches:
            for _, texts in by_slices(batch):
                for t in texts:
                    counts.update(t.split())
                if len(counts) > 4 * held:
                    counts = trimmed(counts, held)
        top = [(w, n) for w, n in trimmed(counts, held).items() if n > 1 and len(w) <= CACHE_CHARS]
        yield pa.RecordBatch.from_arrays([pa.array([w for w, _ in top], pa.binary()), pa.array([n for _, n in top], pa.int64())], names=["word", "n"])

    summed = whole(docs, text).select("body").mapInArrow(run, "word binary, n long").groupBy("word").agg(F.sum("n").alias("n"))
    rows = summed.orderBy(F.desc("n"), "word").limit(most).collect()
    return [bytes(r.word).decode("utf-8", "replace") for r in rows]


def frequent_table(tokenizer_json: str, words: Iterable[str], most: int = FREQUENT) -> tuple[str, bytes]:
    """(pre-tokens joined by NUL, one length a byte) of the words as they stand
    behind a space; the first ``most`` pre-tokens."""
    tok = Tokenizer.from_str(tokenizer_json)
    cut = regex.compile(PRE_TOKEN).findall
    found = dict.fromkeys(p for w in words if not UNUSUAL.search(w) for p in cut(" " + w))
    found = list(found)[:most]
    sizes = [len(e.ids) for e in tok.encode_batch(found, add_special_tokens=False)]
    both = [(w, n) for w, n in zip(found, sizes, strict=True) if n < 256]
    return "\0".join(w for w, _ in both), bytes(n for _, n in both)


class Lengths(dict):
    """Pre-token -> tokens: the broadcast tier, then the worker's cache."""

    def __init__(self, tok: Tokenizer, frequent: tuple[str, bytes]):
        self.tok, self.frequent = tok, frequent
        self.refill()

    def refill(self) -> None:
        self.clear()
        if self.frequent[1]:
            self.update(zip(self.frequent[0].split("\0"), self.frequent[1], strict=True))

    def __missing__(self, word: str) -> int:
        n = len(self.tok.encode(word, add_special_tokens=False).ids)
        if len(word) <= CACHE_CHARS:
            if len(self) >= CACHE_ENTRIES + len(self.frequent[1]):
                self.refill()
            self[word] = n
        return n


def counter(tokenizer_json: str, frequent: tuple[str, bytes]) -> Callable[[str], int]:
    """A function text -> number of tokens, equal to the tokenizer's own
    encode without added special tokens (special strings in a text are one
    token each, its default)."""
    tok = Tokenizer.from_str(tokenizer_json)
    tok.no_truncation()
    tok.no_padding()
    special = [t["content"] for t in json.loads(tokenizer_json)["added_tokens"]]
    cut = regex.compile(PRE_TOKEN).findall
    lengths = Lengths(tok, frequent)
    length, unusual = lengths.__getitem__, UNUSUAL.search

    def count(text: str) -> int:
        if any(s in text for s in special):
            return len(tok.encode(text, add_special_tokens=False).ids)
        if not unusual(text):
            return sum(map(length, cut(text)))
        return sum(length(piece) if unusual(piece) else sum(map(length, cut(piece))) for piece in SAFE.split(text))

    return count


def token_counts(docs: DataFrame, tokenizer_path: str, limit: int = 512, text: str = "text",
                 frequent: Iterable[str] | None = None, carry: list[str] | None = None) -> DataFrame:
    """``docs`` (as the struct ``row``) with n_bytes, n_tokens and over_limit.
    The vocabulary file is read once, on the driver, and sent with tier one.
    ``frequent``: words for it, most frequent first; by default those of ``docs``."""
    with open(tokenizer_path, encoding="utf-8") as f:
        tokenizer_json = f.read()
    frequent = frequent_words(docs, text) if frequent is None else frequent
    shared = docs.sparkSession.sparkContext.broadcast((tokenizer_json, frequent_table(tokenizer_json, frequent)))

    def work():
        count = counter(*shared.value)
        return lambda texts, _: [[len(t) for t in texts], [count(t.decode("utf-8", "replace")) for t in texts]]

    counted = arrow_pass(whole(docs, text, carry), "n_bytes long, n_tokens long", work, keep=["row"])
    return counted.withColumn("over_limit", F.col("n_tokens") > limit)
