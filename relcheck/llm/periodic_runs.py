"""Operator 11: periodic runs of words, caught online.

Method: words are appended to dyadic square catchers (``squares.py``): every
completed block of a power of two words waits for its return, each appended word
advances the comparisons, and squares merge into runs. A run is a stretch of
consecutive words of least period q and at least max(LEAST, 2 q) words that no
neighbouring word extends. What repeats is then taken out: of every run the
first q words stay.

A text is one row and never leaves its task; no rows move between tasks. Its
words are appended APPENDED at a time, so the working memory besides the words
themselves does not grow with them.

Defined results: null, empty and blank texts have no words, no run and an empty
collapsed text; texts without runs come back with their words joined by one
space; rows that repeat are each done alone; overlapping runs each drop their
own words; an empty table gives an empty result; the caller's columns travel in
one struct, so none can clash.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from relcheck.llm.shared import arrow_pass, whole
from relcheck.llm.squares import Catchers

LEAST = 12
APPENDED = 1 << 16


def runs_of(words: list, least: int = LEAST, appended: int = APPENDED) -> list[tuple[int, int, int]]:
    """(first word, length, period) of every run."""
    if len(words) < least:
        return []
    names: dict = {}
    ids = np.fromiter((names.setdefault(w, len(names)) for w in words), np.int64, len(words))
    catchers = Catchers(least)
    for at in range(0, len(ids), appended):
        catchers.append(ids[at:at + appended])
    return catchers.runs()


def collapsed(words: list[bytes], runs: list[tuple[int, int, int]]) -> bytes:
    """The words that no run drops, joined by one space."""
    if not runs:
        return b" ".join(words)
    stays = np.ones(len(words), bool)
    for start, length, period in runs:
        stays[start + period:start + length] = False
    return b" ".join([words[i] for i in np.flatnonzero(stays).tolist()])


def repeated_tail(words: list[bytes], mark: int | None) -> list[bytes]:
    """A text made periodic from some word on, for one mark in ten: a trial of
    the operator. ``mark``: an unsigned hash of the row's id, or none."""
    if mark is None or mark % 10 or not words:
        return words
    g, n = mark // 10, len(words)
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    times = -(-(n - a) // p)
    return words[:a] + (words[a:a + p] * times)[:n - a]


def periodic_runs(docs: DataFrame, text: str = "text", least: int = LEAST, carry: list[str] | None = None,
                  mark: Column | None = None, rewrite: Callable[[list[bytes], int | None], list[bytes]] | None = None) -> DataFrame:
    """(row, n_words long, runs array<struct<start, length, period>>, collapsed
    string). ``rewrite``: what is done to a text's words first, with the row's
    ``mark``."""
    mark = F.lit(None) if mark is None else mark

    def work():
        def do(texts, rows):
            counts, found, texts_out = [], [], []
            for t, m in zip(texts, rows.column("mark").to_pylist(), strict=True):
                words = t.split()
                if rewrite:
                    words = rewrite(words, m)
                runs = runs_of(words, least)
                counts.append(len(words))
                found.append([dict(zip(("start", "length", "period"), r, strict=True)) for r in runs])
                texts_out.append(collapsed(words, runs).decode("utf-8", "replace"))
            return [counts, found, texts_out]
        return do

    rows = whole(docs, text, carry, mark=mark.cast("long"))
    fields = "n_words long, runs array<struct<start: long, length: long, period: long>>, collapsed string"
    return arrow_pass(rows, fields, work, keep=["row", "mark"]).drop("mark")
