import random
import re

from relcheck.llm.automaton import Automaton
from relcheck.llm.decontaminate import contamination, cut, decontaminated, item_blocks, words_of
from tests.llm.helpers import UPPER, docs_of, edge_docs, edge_rows, no_docs, prose

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def tokens(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(LOWER))


def brute(text, items, n=10):
    w, hit, found = tokens(text), set(), set()
    for name, item in items:
        x = tokens(item)
        k = min(n, len(x))
        wins = {tuple(x[i:i + k]) for i in range(len(x) - k + 1)} if k else set()
        for i in range(len(w) - k + 1):
            if k and tuple(w[i:i + k]) in wins:
                hit |= set(range(i, i + k))
                found.add(str(name))
    return len(w), len(hit), sorted(found)


def small_texts(seed, n, words):
    r = random.Random(seed)
    return [" ".join(r.choice("ab ba c d, e.") for _ in range(words)) for _ in range(n)]


def test_automaton_equals_brute_force():
    items = list(enumerate(small_texts(1, 12, 9))) + [(50, "c d"), (51, "c d"), (52, "")]
    for n in (2, 3, 5):
        a = Automaton([(str(i), words_of(t.encode())) for i, t in items], n)
        for t in small_texts(2, 60, 25):
            spans, found, longest = a.scan(words_of(t.encode()))
            want = brute(t, items, n)
            assert (sum(b - x for x, b in spans), sorted(found)) == want[1:]
            assert all(x < y for (_, x), (y, _) in zip(spans, spans[1:], strict=False)) and longest >= (n if want[1] else 0) - n


def bench(spark, items):
    return spark.createDataFrame(items, "item_id long, text string")


def test_documents_equal_brute_force_in_one_and_many_blocks(spark):
    items = [(i, prose(100 + i, 12 + 9 * i)) for i in range(9)] + [(20, "just three words"), (21, None), (22, ""), (22, "just three words")]
    texts = [prose(7, 50) + " " + items[3][1] + " " + prose(8, 40), items[5][1].translate(UPPER), "so just, three! words here", None, "",
             prose(9, 30) + " " + " ".join(items[8][1].split()[5:30]), prose(11, 200)]
    docs, b = docs_of(spark, texts), bench(spark, items)
    for block_words in (60_000, 40):
        out = contamination(docs, b, block_words=block_words).select("row.doc_id", "n_words", "n_hit", "items", "spans").collect()
        got = {r.doc_id: (r.n_words, r.n_hit, r["items"]) for r in out}
        assert got == {i: brute(t, items) for i, t in enumerate(texts)}
        assert all(x.b < y.a for r in out for x, y in zip(r.spans, r.spans[1:], strict=False))


def test_edges(spark):
    docs, items = edge_docs(spark), [(1, prose(2, 30)), (None, prose(3, 20))]
    assert contamination(docs, bench(spark, items)).count() == len(edge_rows())
    assert {r.doc_id for r in contamination(docs, bench(spark, items)).where("n_hit > 0").select("row.doc_id").collect()} == {11, 12}
    assert contamination(docs, bench(spark, [])).where("n_hit > 0").count() == 0
    assert contamination(no_docs(spark), bench(spark, items)).count() == 0


def test_blocks_are_bounded_when_rows_share_an_id(spark):
    texts = [prose(500 + i, 15) for i in range(25)]
    rows = [(1, t) for t in texts] + [(None, t) for t in texts] + [(1, texts[0])] * 20
    blocks = list(item_blocks(bench(spark, rows), 10, "text", "item_id", 120))
    held = [(item, b" ".join(ws)) for block in blocks for item, ws in block]
    assert max(sum(len(ws) for _, ws in block) for block in blocks) <= 120
    assert sorted(held) == sorted((item, b" ".join(words_of(t.encode()))) for item in ("1", "null") for t in texts)


def test_cut_removes_the_passage_and_keeps_clean_documents(spark):
    item, before, after = prose(300, 40), prose(301, 60), prose(302, 60)
    docs = docs_of(spark, [f"{before} {item} {after}", item, before, None])
    docs = docs.selectExpr("*", "cast(length(text) as long) as n_chars")
    left = {r.doc_id: r for r in decontaminated(docs, bench(spark, [(1, item)]), counts=("n_chars",)).collect()}
    assert set(left) == {0, 2, 3} and left[2].text == before and left[3].text is None and left[3].n_chars is None
    assert tokens(left[0].text) == tokens(before) + tokens(after) and left[0].n_chars == len(left[0].text)
    assert decontaminated(docs, bench(spark, [(1, item)])).columns == docs.columns


def test_cut_in_bytes():
    assert cut("á bé, cé! dé".encode(), [(1, 3)]).decode() == "á ! dé"
