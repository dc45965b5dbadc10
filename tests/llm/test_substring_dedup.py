from relcheck.llm.shared import WordHashes
from relcheck.llm.substring_dedup import MIN_UNITS, MIN_WORDS, WINDOW, cut, runs, substring_dedup, units
from tests.llm.helpers import UPPER, docs_of, edge_docs, edge_rows, no_docs, prose


def brute(texts):
    """Units that go, by text: those of a run that occurred before."""
    h, seen, out = WordHashes(), set(), []
    for t in texts:  # ids rise with the place in the list
        first, words = units((t or "").encode(), h)
        bounds, gone = [*first.tolist(), len(words)], set()
        n, spans = len(first), []
        for i in range(n):
            spans += [(i, j) for j in range(i + MIN_UNITS, n + 1) if bounds[j] - bounds[i] >= MIN_WORDS][:1]
        if spans and spans[-1][1] < n:
            spans.append((spans[-1][0], n))
        for i, j in spans:
            run = tuple(words[bounds[i]:bounds[j]].tolist())
            if run in seen:
                gone |= set(range(i, j))
            seen.add(run)
        out.append(sorted(gone))
    return out


def test_equals_brute_force(spark):
    passage = prose(900, 70)
    texts = [prose(i, 90) for i in range(5)] + [prose(20, 33) + " " + passage + " " + prose(21, 30), passage, prose(22, 7) + " " + passage.translate(UPPER),
             None, "", passage + " " + passage, prose(0, 90), "a b c. " * 40]
    got = {r.doc_id: (r.removed, r.clean, r.n_words_removed) for r in substring_dedup(docs_of(spark, texts)).select("row.doc_id", "removed", "clean", "n_words_removed").collect()}
    want = brute(texts)
    assert [got[i][0] for i in range(len(texts))] == want
    assert not any(want[:6]) and want[6] and want[7] and want[10] and got[11][1] == ""
    assert all(len((t or "").split()) - len(got[i][1].split()) == got[i][2] for i, t in enumerate(texts))


def test_a_passage_of_over_fifty_words_is_found_wherever_it_starts(spark):
    texts, inside = [], []
    for i in range(40):
        passage = prose(1000 + i, 51 + i % 9)
        texts += [prose(2 * i, 11 + i % 7) + " " + passage + " " + prose(3000 + i, 9), prose(5000 + i, 5 + i % 3) + " " + passage + " " + prose(7000 + i, 14)]
        inside.append(passage)
    got = {r.doc_id: r.clean for r in substring_dedup(docs_of(spark, texts)).select("row.doc_id", "clean").collect()}
    assert all(got[2 * i] == texts[2 * i] for i in range(40))  # the first place stays
    lost = [len(texts[2 * i + 1].split()) - len(got[2 * i + 1].split()) for i in range(40)]
    assert min(lost) >= MIN_WORDS and max(lost) <= 51 + 8


def test_edges(spark):
    docs = edge_docs(spark)
    out = substring_dedup(docs).select("row.*", "clean", "removed").collect()
    assert len(out) == len(edge_rows())
    by = {}
    for r in out:
        by.setdefault(r.doc_id, []).append(r)
    assert by[1][0].clean == "" and by[2][0].clean == "" and by[4][0].clean == "one"
    assert by[13][0].removed == by[13][1].removed == []  # one document
    assert by[None][0].clean + by[None][1].clean == edge_rows()[9][1]  # sorts first
    assert by[6][0].clean == by[7][0].clean == by[9][0].clean == "" and len(by[8][0].clean.split()) < 30
    assert substring_dedup(no_docs(spark)).count() == 0


def test_cut_keeps_white_space_of_what_stays():
    t = b"One two. Three four!\n  Five six; seven."
    first, words = units(t, WordHashes())
    assert first.tolist() == [0, 2, 4]
    assert cut(t, set(), first, len(words)) == t
    assert cut(t, {1}, first, len(words)) == b"One two.\n  Five six; seven."
    assert cut(t, {0, 1, 2}, first, len(words)) == b""


def test_no_unit_is_long():
    h = WordHashes()
    for i in range(20):
        first, words = units((prose(i, 300).replace(".", "") + " x." + " same" * 40).encode(), h)
        assert max(b - a for a, b in zip(first, [*first[1:], len(words)], strict=True)) <= WINDOW


def test_run_hashes_depend_on_words_alone():
    h = WordHashes()
    a, b = units(b"x y z. " + prose(1, 80).encode(), h), units(prose(1, 80).encode(), h)
    assert set(runs(*b)[0].tolist()) <= set(runs(*a)[0].tolist())
