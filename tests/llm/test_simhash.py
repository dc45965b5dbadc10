import itertools
import random
import re

import numpy as np
import pytest
import xxhash

import __spark_entry__ as E
from relcheck.llm.pivots import cells, distances, fingerprint, near_pairs, references
from relcheck.llm.simhash import FULL, PARTS, near_links, simhash_duplicates
from tests.conftest import SF
from tests.llm.helpers import docs_of, edge_docs, edge_rows, no_docs, prose

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute_print(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))
    s = [" ".join(w[i:i + 3]) for i in range(len(w) - 2)] if len(w) >= 3 else [" ".join(w)] if w else []
    h = [xxhash.xxh64_intdigest(x.encode(), seed=42) for x in s]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def roots(prints, most=2):
    """The least place reachable, by comparing all pairs."""
    group = list(range(len(prints)))

    def find(x):
        while group[x] != x:
            x = group[x]
        return x
    for i, j in itertools.combinations(range(len(prints)), 2):
        if (prints[i] ^ prints[j]).bit_count() <= most:
            a, b = sorted((find(i), find(j)))
            group[b] = a
    return [find(i) for i in range(len(prints))]


def brute(rows):
    """[(id, hex fingerprint, component)] of rows with distinct ids."""
    rows = sorted(rows)
    prints = [brute_print(t) for _, t in rows]
    return [(d, f"{p:016x}", rows[r][0]) for (d, _), p, r in zip(rows, prints, roots(prints), strict=True)]


@pytest.mark.parametrize("text", ["", " \n", "One", "one TWO", "a b c", "Äb cÉ d e f", prose(3, 900), "x " * 40_000])
def test_fingerprint(text):
    assert fingerprint(text.encode()) == brute_print(text)


@pytest.mark.parametrize("parts", PARTS)
def test_fingerprints_two_bits_apart_share_a_cell(parts):
    x = 0x0123456789ABCDEF
    others = [x ^ 1 << i ^ 1 << j for i in range(64) for j in range(i, 64)] + [x]
    found = cells(np.array([x, *others], np.uint64), parts)
    assert (found[1:] == found[0]).any(axis=1).all()


def test_cells_of_the_last_table_are_small():
    r = random.Random(1)
    prints = np.unique(np.array([r.getrandbits(64) & 0xFFF for _ in range(9000)], np.uint64))
    found = cells(prints, PARTS[-1])
    assert max(np.unique(c, return_counts=True)[1].max() for c in found.T) <= FULL


def test_pairs_by_distance_table():
    r = random.Random(2)
    prints = [r.getrandbits(64) for _ in range(30)]
    prints += [p ^ 1 << r.randrange(64) ^ 1 << r.randrange(64) for p in prints] + [p ^ 7 for p in prints]
    a = np.array(prints, np.uint64)
    got = set(zip(*(x.tolist() for x in near_pairs(a, distances(a, references()), 2)), strict=True))
    assert got == {(i, j) for i, j in itertools.combinations(range(len(a)), 2) if (prints[i] ^ prints[j]).bit_count() <= 2}


def test_crowded_cells_lose_no_link(spark):
    """One mass of fingerprints that differ in 13 bits, far over a cell's bound,
    some of them linked with the mass by one chain only, and a few single ones."""
    r = random.Random(3)
    base = r.getrandbits(64)
    free = r.sample(range(64), 13)
    prints = {base ^ sum(1 << b for b in free if r.random() < 0.5) for _ in range(1200)}
    far = base ^ sum(1 << b for b in range(64) if b not in free and r.random() < 0.5)
    prints |= {far ^ (1 << k) - 1 for k in range(0, 40, 2)} | {r.getrandbits(64) for _ in range(60)}
    prints = sorted(prints)
    signed = np.array(prints, np.uint64).view(np.int64).tolist()
    links = near_links(spark.createDataFrame([(p,) for p in signed], "print long")).collect()
    place, group = {p: i for i, p in enumerate(signed)}, list(range(len(prints)))
    assert all((prints[place[x.a]] ^ prints[place[x.b]]).bit_count() <= 64 for x in links)
    for _ in prints:
        before = list(group)
        for x in links:
            i, j = place[x.a], place[x.b]
            group[i] = group[j] = min(group[i], group[j])
        if before == group:
            break
    assert group == roots(prints)


def test_groups_equal_brute_force(spark):
    r, texts = random.Random(5), []
    for seed in range(12):
        words = prose(seed, 400).split()
        for _ in range(6):
            w = list(words)
            for _ in range(r.randrange(4)):
                w[r.randrange(len(w))] = f"new{r.randrange(99)}"
            texts.append(" ".join(w))
    texts += ["", None, " ", "a", "A", "a b", "one two three", "One  two\nTHREE"]
    got = sorted((x.id, f"{x.print & (1 << 64) - 1:016x}", x.component) for x in simhash_duplicates(docs_of(spark, texts)).collect())
    assert got == brute(list(enumerate(texts)))


def test_edges(spark):
    rows = simhash_duplicates(edge_docs(spark)).collect()
    assert len(rows) == len(edge_rows())
    by = {}
    for x in rows:
        by.setdefault(x.id, []).append(x)
    assert [by[d][0].component for d in (1, 2, 3, 6, 7, 9)] == [1, 1, 1, 6, 6, 6] and by[1][0].print == 0
    assert sorted(x.component for x in by[None]) == [1, 6]  # the blank one, and the copy of text 6
    assert len({x.print for x in by[12]}) == 2 and len({x.print for x in by[13]}) == 1
    assert simhash_duplicates(no_docs(spark)).count() == 0
    alone = spark.createDataFrame([(None, "a b c d")], "doc_id long, text string")
    assert [x.component for x in simhash_duplicates(alone).collect()] == [None]


def test_a_third_of_all_rows_are_copies(spark):
    texts = ["the same text in many rows"] * 300 + [prose(s, 30) for s in range(600)]
    rows = simhash_duplicates(docs_of(spark, texts)).collect()
    assert sum(x.component == 0 for x in rows) == 300


def test_query_equals_brute_force(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    got = sorted((r.doc_id, r.fingerprint, r.component_id) for r in E.queries()["op13_simhash"](spark, SF).collect())
    assert got == brute(rows)
