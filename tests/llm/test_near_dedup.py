import random
import re

import numpy as np

from relcheck.llm.circulant import signature, word_set
from relcheck.llm.components import components
from relcheck.llm.near_dedup import first_of_each, near_duplicates, one_of_each, prefix_pairs
from relcheck.llm.shared import WordHashes
from tests.llm.helpers import docs_of, edge_docs, edge_rows, no_docs, prose

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def shingles(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))
    return {tuple(w[i:i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set()


def brute(rows):
    """[(id, n_shingles, component)] of rows with distinct ids."""
    sets = {d: shingles(t) for d, t in rows}
    group = {d: d for d in sets}
    for _ in sets:
        for a in sets:
            for b in sets:
                both = len(sets[a] & sets[b])
                if both and 100 * both >= 75 * len(sets[a] | sets[b]):
                    group[a] = group[b] = min(group[a], group[b])
    return sorted((d, len(sets[d]), group[d]) for d in sets)


def near_copies(n, seed=0):
    """A chain-like group: copies of one text, each changed a little more."""
    r = random.Random(seed)
    base, out = prose(99, 90).split(), []
    for i in range(n):
        w = list(base)
        for _ in range(r.randrange(0, 6)):
            w[r.randrange(len(w))] = f"new{i}x{r.randrange(9)}"
        out.append(" ".join(w))
    return out


def test_groups_equal_brute_force(spark):
    texts = near_copies(25) + [prose(s, 60) for s in range(8)] + ["a b", "a b", "a  B", "", None, "x y z q w e"]
    docs = docs_of(spark, texts)
    got = sorted((r.id, r.n_shingles, r.component) for r in near_duplicates(docs).collect())
    assert got == brute(list(enumerate(texts)))


def test_edges(spark):
    rows = near_duplicates(edge_docs(spark)).collect()
    assert len(rows) == len(edge_rows())
    by = {}
    for r in rows:
        by.setdefault(r.id, []).append(r)
    assert all(r.component is None and r.kept for r in by[None])
    assert by[1][0].n_shingles == by[2][0].n_shingles == by[3][0].n_shingles == 0 and by[1][0].kept
    assert [by[d][0].component for d in (6, 7, 8, 9)] == [6] * 4
    assert near_duplicates(no_docs(spark)).count() == 0


def test_first_of_each_keeps_one(spark):
    docs = edge_docs(spark)
    left = first_of_each(docs)
    assert left.columns == docs.columns
    ids = [r.doc_id for r in left.select("doc_id").collect()]
    assert ids.count(6) == 1 and not {7, 8, 9} & set(ids)
    assert ids.count(13) == 1 and ids.count(None) == 2 and ids.count(12) == 1
    assert {1, 2, 3, 4, 5, 10, 11, 14, 15} <= set(ids)
    assert first_of_each(no_docs(spark)).count() == 0


def test_one_of_each_keeps_different_texts_of_one_id(spark):
    docs = edge_docs(spark)
    left = one_of_each(docs)
    assert left.columns == docs.columns
    rows = left.select("doc_id", "text").collect()
    ids = [r.doc_id for r in rows]
    assert ids.count(12) == 2 and ids.count(13) == 1 and ids.count(6) == 1 and not {7, 8, 9} & set(ids)
    assert [r.text for r in rows if r.doc_id is None] == [None]  # the other is a copy of 6
    assert {1, 2, 3, 4, 5, 10, 11, 14, 15} <= set(ids)
    assert one_of_each(no_docs(spark)).count() == 0


def test_one_of_each_with_one_id_on_many_rows(spark):
    base, lone = prose(99, 90).split(), [prose(s, 60) for s in range(20, 26)]
    same = [" ".join(base[:i] + [f"new{i}"] + base[i + 1:]) for i in range(20, 80, 10)]
    rows = [(7, t) for t in lone + same[:3] + lone[:2] + ["", "", " \n"]] + [(None, t) for t in same + lone[2:4] * 3 + [prose(40, 70)] * 5] + [(5, lone[0])]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted(((r.doc_id, r.text) for r in one_of_each(docs).collect()), key=str)
    linked = brute(list(enumerate(same)))
    assert len({c for _, _, c in linked}) == 1  # the six are one group
    group = [r for r in got if r[1] in same]
    assert len(group) == 1 and group[0][0] == 7
    want = [(5, lone[0])] + [(7, t) for t in lone[1:]] + [(7, ""), (7, " \n"), (None, prose(40, 70))] + group
    assert got == sorted(want, key=str)


def test_signature_estimates_similarity():
    h = WordHashes()
    a, b = (word_set(t.encode(), h) for t in near_copies(40)[3:5])
    true = len(np.intersect1d(a, b)) / len(np.union1d(a, b))
    x, y = signature(a, 2000), signature(b, 2000)
    assert abs((x == y).mean() - true) < 0.05
    assert (signature(a, 240, block=7) == signature(a, 240)).all()


def test_prefix_pairs_lose_nothing(spark):
    r = random.Random(5)
    sets = {i: {r.randrange(60) for _ in range(r.randrange(5, 40))} for i in range(60)}
    for i in range(60, 90):
        sets[i] = {x for x in sets[i - 60] if r.random() < 0.95} | {r.randrange(60)}
    comp = {i: i if i % 3 else 0 for i in sets}  # every third is one large component
    items = spark.createDataFrame([(i, 0, comp[i], len(s), x) for i, s in sets.items() for x in s], "node long, twin long, comp long, n long, s long")
    got = {(x.a, x.b) for x in prefix_pairs(items, 75).collect()}
    want = {(a, b) for a in sets for b in sets if a < b and comp[a] != comp[b] and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b])}
    assert want and want <= got and all(comp[a] != comp[b] for a, b in got)


def test_components(spark):
    r = random.Random(3)
    edges = [(r.randrange(200), r.randrange(200)) for _ in range(120)] + [(i, i + 1) for i in range(300, 360)]
    group = {x: x for e in edges for x in e}
    for _ in range(400):
        for a, b in edges:
            group[a] = group[b] = min(group[a], group[b])
    got = {x.node: x.component for x in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {x: c for x, c in group.items() if any(a != b and x in (a, b) for a, b in edges)}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0
