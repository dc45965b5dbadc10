import math
import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from relcheck.llm import sharding
from relcheck.llm.mixing import mix, mixed, targets, words_of
from relcheck.llm.sharding import shard_by_bytes, sort_key, splitters
from tests.llm.helpers import docs_of, edge_docs, edge_rows, no_docs, prose


def test_shards_are_equal_in_bytes_and_slots_gapless(spark):
    r = random.Random(1)
    docs = docs_of(spark, [prose(i, r.randrange(1, 60)) for i in range(900)])
    rows = shard_by_bytes(docs, 24).select("row.*", "size", "k", "shard", "slot").collect()
    assert len(rows) == 900 and {x.shard for x in rows} == set(range(24))
    sums, slots = defaultdict(int), defaultdict(list)
    for x in rows:
        assert x.size == len(x.text.encode()) + 8
        sums[x.shard] += x.size
        slots[x.shard].append((x.slot, x.k))
    most = max(x.size for x in rows)
    assert max(sums.values()) - min(sums.values()) <= 2 * most
    for s in slots.values():
        s.sort()
        assert [i for i, _ in s] == list(range(len(s))) and [k for _, k in s] == sorted(k for _, k in s)


def test_splitters_are_exact(spark):
    r = random.Random(2)
    keys = [r.randrange(1 << 60) for _ in range(300)] + [7] * 40 + [8] * 3 + [(1 << 60) - 1]
    data = [(k, r.randrange(1, 50)) for k in keys]
    cuts, n, size = splitters(spark.createDataFrame([(k, 10) for k, _ in data[-50:]] + [(k, 7 + k % 5) for k, _ in data[:-50]], "k long, size long"), 10)
    data = [(k, 10) for k, _ in data[-50:]] + [(k, 7 + k % 5) for k, _ in data[:-50]]
    total = sum(s for _, s in data)
    seen, ordered = defaultdict(int), []
    for k, s in sorted(data):
        ordered.append((k, seen[k], s))
        seen[k] += 1
    for i, (key, rank, below) in enumerate(cuts, 1):
        want = -(-total * i // 10)
        first = [x for x in ordered if x[:2] < (key, rank)]
        assert len(first) == below and sum(s for _, _, s in first) >= want > sum(s for _, _, s in first[:-1])
    assert (n, size) == (len(data), total)


def test_equal_rows_are_shared_out(spark, monkeypatch):
    """Half of all rows are one row, without an id; a few more repeat."""
    monkeypatch.setattr(sharding, "CELL_ROWS", 16)
    rows = [(None, "the same text")] * 600 + [(7, "another one")] * 40 + [(i, prose(i, 2)) for i in range(500)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    out = shard_by_bytes(docs, 24).collect()
    assert len(out) == len(rows)
    sums, slots = defaultdict(int), defaultdict(list)
    for x in out:
        sums[x.shard] += x.size
        slots[x.shard].append(x.slot)
    assert set(sums) == set(range(24)) and max(sums.values()) - min(sums.values()) <= 2 * max(x.size for x in out)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert len({x.shard for x in out if x.row.doc_id is None}) > 8


def test_a_few_equal_rows_stay_together(spark, monkeypatch):
    monkeypatch.setattr(sharding, "FINE", 1)
    rows = [(i // 3, prose(i // 3, 12)) for i in range(1800)]
    out = shard_by_bytes(spark.createDataFrame(rows, "doc_id long, text string"), 8).collect()
    slots, homes = defaultdict(list), defaultdict(set)
    for x in out:
        slots[x.shard].append(x.slot)
        homes[x.row.doc_id].add(x.shard)
    assert len(out) == 1800 and all(len(h) == 1 for h in homes.values()) and all(sorted(s) == list(range(len(s))) for s in slots.values())


def test_sharding_edges(spark, monkeypatch):
    monkeypatch.setattr(sharding, "CELL_ROWS", 2)
    docs = edge_docs(spark)
    rows = shard_by_bytes(docs, 5).collect()
    assert len(rows) == len(edge_rows())
    assert {x.size for x in rows if x.row.doc_id in (1, 2)} == {8}
    slots = defaultdict(list)
    for x in rows:
        slots[x.shard].append(x.slot)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert shard_by_bytes(no_docs(spark), 5).count() == 0
    assert shard_by_bytes(docs.limit(2), 24).count() == 2


def test_key_tells_null_from_empty_and_other_cuts(spark):
    rows = spark.createDataFrame([(None, "a"), ("", "a"), ("a", ""), ("a", None), ("1.a", "b"), ("1", ".ab")], "x string, y string")
    assert rows.select(sort_key(F.col("x"), F.col("y")).alias("k")).distinct().count() == 6


def fill(own, weights=(5, 2, 1), most=3):
    total, full = sum(own), set()
    w = [weights[i % len(weights)] for i in range(len(own))]
    while True:
        left = total - sum(most * own[i] for i in full)
        rest = sum(w[i] for i in range(len(own)) if i not in full)
        over = {i for i in range(len(own)) if i not in full and w[i] * left > most * own[i] * rest}
        if not over:
            return [most * own[i] if i in full else w[i] * left / rest if rest else 0.0 for i in range(len(own))]
        full |= over


@pytest.mark.parametrize("own", [[100, 50, 30], [5, 1000, 2000, 1, 0, 9, 400], [7], [0, 0], [10_000_000, 1]])
def test_targets_equal_brute_force(spark, own):
    names = [f"s{i:02}" for i in range(len(own) - 1)] + [None]
    got = {r.source: r.target for r in targets(spark.createDataFrame(list(zip(names, own, strict=True)), "source string, own long")).collect()}
    assert all(math.isclose(got[n], t, abs_tol=1e-9) for n, t in zip(names, fill(own), strict=True))


def test_mix_meets_targets_and_reruns_agree(spark):
    r = random.Random(4)
    rows = [(i, prose(i, r.randrange(1, 40)), r.choice(["a", "a", "a", "b", "c", "d", None])) for i in range(800)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    out = [(x.row.doc_id, x.row.source, x["size"], x.source_size, x.target, x.copies) for x in mix(docs).collect()]
    again = [(x.row.doc_id, x.row.source, x["size"], x.source_size, x.target, x.copies) for x in mix(docs.repartition(5)).collect()]
    assert sorted(out, key=str) == sorted(again, key=str) and len(out) == 800
    for s in ("a", "b", "c", "d", None):
        mine = [x for x in out if x[1] == s]
        assert {x[3] for x in mine} == {sum(x[2] for x in mine)} and {x[5] for x in mine} <= {0, 1, 2, 3}
        assert abs(sum(x[2] * x[5] for x in mine) - mine[0][4]) <= max(x[2] for x in mine)
    assert mixed(docs).count() == sum(x[5] for x in out) and mixed(docs).columns == docs.columns


def test_mixing_edges(spark):
    out = mix(edge_docs(spark)).collect()
    assert len(out) == len(edge_rows()) and all(x["size"] == 0 for x in out if x.row.doc_id in (1, 2, 3))
    twins = {x.copies for x in out if x.row.doc_id == 13}
    assert len(twins) == 1  # rows alike are taken alike
    assert mix(no_docs(spark)).count() == 0 and mixed(no_docs(spark)).count() == 0
    assert mix(docs_of(spark, [None, ""])).agg(F.sum("copies")).first()[0] == 0
    assert [r[0] for r in docs_of(spark, ["a\x0bb\x0cc\rd é", "x\x85y\xa0z", None]).orderBy("doc_id").select(words_of()).collect()] == [5, 1, 0]
