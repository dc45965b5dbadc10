"""Every registered corpus query against its SQL, and the pipeline against
brute force."""

import math
import re
from collections import defaultdict

import pytest

import __spark_entry__ as E
import corpus_pipeline
from tests.compare import compare, duck
from tests.conftest import SF
from tests.llm import test_decontaminate, test_near_dedup, test_quality, test_sharding_mixing

OPS = [k for k in E.queries() if re.match(r"op\d+_", k)]


@pytest.fixture(scope="module")
def con():
    return duck(SF)


def test_one_query_an_operator():
    assert sorted(int(k[2:].split("_")[0]) for k in OPS) == list(range(1, 14))
    assert "pipeline" in E.queries()


@pytest.mark.parametrize("key", [k for k in OPS if k in E.oracle_sql()])
def test_query_equals_sql(spark, con, key):
    assert compare(E.queries()[key](spark, SF), con, E.oracle_sql()[key]) == []


@pytest.mark.parametrize("key", [k for k in OPS if k not in E.oracle_sql()])  # op12, on conversations, has SQL
def test_query_has_a_row_a_document(spark, key):
    ids = sorted(r.doc_id for r in E.queries()[key](spark, SF).select("doc_id").collect())
    assert ids == sorted(r.doc_id for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id").collect())


def stage(spark, tmp_path, name, docs):
    path = str(tmp_path / name.replace(" ", "_"))
    dict(corpus_pipeline.STAGES)[name](spark, docs, SF).write.parquet(path)
    return spark.read.parquet(path)


def test_pipeline_equals_brute_force(spark, tmp_path):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = {r.doc_id: r for r in docs.collect()}
    kept = stage(spark, tmp_path, "quality rules", docs)
    verdict = {r.doc_id: r.kept for r in E.queries()["op8_quality"](spark, SF).collect()}
    assert {r.doc_id for r in kept.collect()} == {d for d, k in verdict.items() if k} and kept.columns == docs.columns
    for d, k in verdict.items():  # no document without words, and none that is mostly repeats, stays
        n, *_, repeats = test_quality.brute(rows[d].text)
        assert not (k and (n < 50 or 100 * repeats > 50 * n))

    left = stage(spark, tmp_path, "near-duplicates", kept)
    want = {c for _, _, c in test_near_dedup.brute([(r.doc_id, r.text) for r in kept.collect()])}
    assert {r.doc_id for r in left.collect()} == want

    clean = stage(spark, tmp_path, "benchmark decontamination", left)
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    after = {r.doc_id: r for r in clean.collect()}
    for r in left.collect():
        n, hit, _ = test_decontaminate.brute(r.text, items)
        assert (r.doc_id in after) == (2 * hit <= n)
        if r.doc_id in after:
            now = after[r.doc_id]
            assert len(test_decontaminate.tokens(now.text)) == n - hit and now.n_chars == (r.n_chars if not hit else len(now.text))
            assert hit or now == r

    mixed = stage(spark, tmp_path, "source mixing", clean)
    size, taken, times = defaultdict(int), defaultdict(int), defaultdict(int)
    words = lambda t: len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))
    for r in after.values():
        size[r.source] += words(r.text)
    for r in mixed.collect():
        taken[r.source] += words(r.text)
        times[r.doc_id] += 1
    names = sorted(size)
    for s, t in zip(names, test_sharding_mixing.fill([size[s] for s in names]), strict=True):
        assert abs(taken[s] - t) <= max(words(r.text) for r in after.values() if r.source == s)
    assert max(times.values()) <= 3

    placed = stage(spark, tmp_path, "sharding", mixed).collect()
    assert len(placed) == sum(times.values())
    sums, slots = defaultdict(int), defaultdict(list)
    for r in placed:
        sums[r.shard] += len((r.text or "").encode()) + 8
        slots[r.shard].append(r.slot)
    assert all(sorted(v) == list(range(len(v))) for v in slots.values())
    most = 3 * max(len(r.text.encode()) + 8 for r in placed)
    assert max(sums.values()) - min(sums.values()) <= 2 * most and not math.isnan(most)


def test_run_is_the_stages_in_order(spark):
    out = corpus_pipeline.run(spark, SF)
    assert out.columns == ["doc_id", "text", "lang", "source", "n_chars", "shard", "slot"] and out.count() > 0
