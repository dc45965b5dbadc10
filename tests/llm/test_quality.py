import re
from collections import Counter

from relcheck.llm.quality import host_record, host_verdicts, keep_good, measure, measured, quality
from tests.llm.helpers import docs_of, edge_docs, edge_rows, no_docs, prose


def brute(text):
    text = text or ""
    w = re.findall(r"[^\x20\x09-\x0D]+", text)
    grams = Counter(zip(w, w[1:], w[2:], strict=False))
    hit = {j for i in range(len(w) - 2) if grams[tuple(w[i:i + 3])] > 1 for j in range(i, i + 3)}
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text), len(lines), len(lines) - len(set(lines)), len(hit)


def test_measure_equals_brute_force():
    texts = [t for _, t, _ in edge_rows() if t and len(t) < 100_000] + ["a b c a b c a b c", "x\nx\n\n y\x0bz\nx", "é# ü* 東|京\x85nbsp\xa0x", "a a a a a", "a b c d a b c"]
    for t in texts + [""]:
        assert measure(t.encode()) == brute(t), t[:50]


def test_edges(spark):
    out = quality(edge_docs(spark)).collect()
    assert len(out) == len(edge_rows())
    by = {r.key.doc_id: r for r in out}
    assert by[1].n_words == 0 and by[1].base_failed and not by[1].kept and by[6].kept
    left = keep_good(edge_docs(spark))
    assert left.columns == edge_docs(spark).columns
    assert sorted(str(r.doc_id) for r in left.collect()) == sorted(str(r.key.doc_id) for r in out if r.kept)
    assert quality(no_docs(spark)).count() == 0 and keep_good(no_docs(spark)).count() == 0


def test_a_hosts_habit_counts_against_its_failing_documents_only(spark):
    bad = [("dirty", prose(i, 80, "###")) for i in range(30)] + [("dirty", prose(100 + i, 80)) for i in range(10)]
    good = [("fine", prose(200 + i, 80)) for i in range(200)] + [("fine", prose(500, 80, "###"))]
    rows = [(i, t, s) for i, (s, t) in enumerate(bad + good)]
    out = {r.key.doc_id: r for r in quality(spark.createDataFrame(rows, "doc_id long, text string, source string")).collect()}
    assert not any(out[i].kept for i in range(30))  # fail a rule that their host breaks habitually
    assert all(out[i].kept for i in range(30, 240))  # clean documents, whatever the host
    assert out[240].kept and out[240].n_symbols > 0  # one slip on a host without the habit


def test_small_hosts_are_shrunk_towards_all(spark):
    rows = [(i, prose(i, 80, "###" if i == 0 else ""), "tiny" if i == 0 else f"h{i % 5}") for i in range(300)]
    counts = measured(spark.createDataFrame(rows, "doc_id long, text string, source string"))
    verdicts = {r.of_host: r.habit_symbols for r in host_verdicts(host_record(counts), habit=0.5).collect()}
    assert not verdicts["tiny"]  # one failure of one document proves little
    assert docs_of(spark, ["x"]).count() == 1
