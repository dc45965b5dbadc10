import hashlib
import random
import re
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

import __spark_entry__ as E
from relcheck.llm.periodic_runs import collapsed, periodic_runs, runs_of
from relcheck.llm.squares import Catchers
from tests.conftest import SF
from tests.llm.helpers import docs_of, edge_docs, edge_rows, no_docs


def brute(words, least=12):
    """Every maximal stretch of each distance, the least distance of each."""
    best, n = {}, len(words)
    for q in range(1, n // 2 + 1):
        i = 0
        while i < n - q:
            j = i
            while j < n - q and words[j] == words[j + q]:
                j += 1
            if j - i >= q and j + q - i >= least:
                best.setdefault((i, j + q), q)
            i = j + 1
    return sorted(((a, b - a, q) for (a, b), q in best.items()), key=lambda r: (r[0], r[2]))


def in_pieces(words, sizes, least=12):
    c, at = Catchers(least), 0
    for k in [*sizes, len(words)]:
        c.append(np.array(words[at:at + k], np.int64))
        at += k
    return c.runs()


@settings(max_examples=300, deadline=None)
@given(st.lists(st.integers(0, 2), max_size=120), st.lists(st.integers(1, 9), max_size=12), st.integers(5, 12))
def test_small_alphabets(words, sizes, least):
    want = brute(words, least)
    assert in_pieces(words, [], least) == want
    assert in_pieces(words, sizes, least) == want


@pytest.mark.parametrize("seed", range(60))
def test_planted_runs(seed):
    r = random.Random(seed)
    words = [r.randrange(30) for _ in range(r.randrange(500))]
    for _ in range(r.randrange(4)):
        p, n = r.choice([1, 2, 3, 5, 6, 7, 13, 14, 15, 30, 31, 62, 100]), r.randrange(20, 300)
        unit = [r.randrange(40) for _ in range(p)]
        at = r.randrange(len(words) + 1)
        words[at:at] = (unit * n)[:n]
    want = brute(words)
    assert runs_of(words) == want
    assert in_pieces(words, [1] * len(words)) == want  # a word a call
    assert runs_of(words, appended=64) == want


@pytest.mark.parametrize("make", [
    lambda: [0] * 3000, lambda: [0, 1] * 1500, lambda: [0] * 700 + [1] + [0] * 700, lambda: list(range(9)) * 2,
    lambda: list(range(40)) * 2 + [0], lambda: (list(range(500)) * 2 + [7]) * 2, lambda: [0] * 11, lambda: [0] * 12,
    lambda: [[0, 1][bin(i).count("1") % 2] for i in range(1024)],
    lambda: [int(c) for c in __import__("functools").reduce(lambda a, _: (a[1], a[1] + a[0]), range(14), ("0", "01"))[1]]])
def test_shapes(make):
    words = make()
    assert runs_of(words) == brute(words) and runs_of(words, appended=37) == brute(words)


def test_long_periodic_texts_take_little_time():
    import time
    began = time.time()
    assert runs_of([0] * 300_000) == [(0, 300_000, 1)]
    unit = list(range(1, 70_001))
    assert runs_of([0] + unit * 4) == [(1, 280_000, 70_000)]
    assert time.time() - began < 20


def planted(doc_id, text):
    w = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    h, n = zlib.crc32(str(doc_id).encode()), len(w)
    if h % 10 or not n:
        return w
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]


def digest(doc_id, text):
    w = planted(doc_id, text)
    runs = brute(w)
    drop = {i for s, n, q in runs for i in range(s + q, s + n)}
    s, n, q = min(runs, key=lambda r: (-r[1], r[0], r[2]), default=(None,) * 3)
    sha = lambda x: hashlib.sha256(x.encode()).hexdigest()
    return (doc_id, len(runs), s, n, q, None if s is None else 1000 * n // q, sha("".join(f"{a},{b},{c}\n" for a, b, c in runs)),
            sha(" ".join(x for i, x in enumerate(w) if i not in drop)))


def test_query_equals_brute_force(spark):
    rows = [r for r in spark.read.parquet(f"{SF}/documents.parquet").collect() if len(r.text or "") < 20_000]
    got = {r.doc_id: tuple(r) for r in E.queries()["op11_periodic_runs"](spark, SF).collect()}
    assert len(got) == spark.read.parquet(f"{SF}/documents.parquet").count()
    for r in rows:
        assert got[r.doc_id] == digest(r.doc_id, r.text)
    assert sum(digest(r.doc_id, r.text)[1] > 0 for r in rows) > 10


def test_edges(spark):
    rows = periodic_runs(edge_docs(spark)).collect()
    assert len(rows) == len(edge_rows())
    by = {}
    for x in rows:
        by.setdefault(x.row.doc_id, []).append(x)
    for d in (1, 2, 3, None):
        assert all(x.runs == [] for x in by[d] if x.n_words == 0)
    assert by[2][0].collapsed == "" and by[4][0].collapsed == "one"
    (run,) = by[15][0].runs  # forty times two words
    assert tuple(run) == (0, 80, 2) and by[15][0].collapsed == "東京 über"
    assert by[6][0].collapsed == by[7][0].collapsed == " ".join(edge_rows()[5][1].split())
    assert periodic_runs(no_docs(spark)).count() == 0


def test_overlapping_runs_drop_their_own_words(spark):
    words = [b"a"] * 12 + [b"b"] * 12 + ([b"a"] * 12 + [b"b"] * 12) * 2
    (x,) = periodic_runs(docs_of(spark, [b" ".join(words).decode()])).collect()
    runs = [tuple(r) for r in x.runs]
    assert runs == brute(words) and len(runs) == 7
    assert x.collapsed.encode() == collapsed(words, runs) == b"a b"
