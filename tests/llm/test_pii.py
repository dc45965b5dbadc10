import hashlib
import re

import numpy as np

from relcheck.llm import crf as C
from relcheck.llm.pii import masked, personal_data
from relcheck.llm.pii_rules import base_spans, code_points
from tests.conftest import SF
from tests.llm.helpers import docs_of, edge_docs, edge_rows, no_docs

PATTERNS = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
            "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def luhn(d):
    return sum(sum(divmod(2 * int(c), 10)) if i % 2 else int(c) for i, c in enumerate(reversed(d))) % 10 == 0


def brute(text):
    out = []
    for kind, p in PATTERNS.items():
        for m in re.finditer(p, text or ""):
            digits = re.sub("[^0-9]", "", m.group())
            if (kind == "email" or kind == "ip" and all(len(x.lstrip("0")) < 4 and int(x.lstrip("0") or 0) <= 255 for x in m.group().split(".")) or kind == "card" and 13 <= len(digits) <= 19 and luhn(digits)
                    or kind == "phone" and 9 <= len(digits) <= 15):
                out.append((kind, *m.span()))
    return out


STRANGE = ["a@b.c@d.e", "@x.y", "a@b", "über.a@b.c-d.e.", "a@b..c", "x@y.z@", "1.2.3.4.5.6.7.8", "256.1.1.1", "001.02.3.4", "1.2.3", "1.2.3.4.5",
           "4111 1111 1111 1111", "4111-1111-1111-1112", "4111  1111", "+1 (212) 555-0134", "+1", "+12-", "++123456789", "+1 +1 123 456 789", "+1 (1) 5.5.5.5 123456789012",
           "日本 a@b.cd 東 1.2.3.4 +44 20 7946 0958", "....1.2.3.4", "a@@b.c", "a.b@c.d-", "-@-.-", "%@a.b", "0" * 5000 + ".1.2.3", "1" * 30, "4" * 16, ""]


def test_base_equals_patterns():
    for t in [*STRANGE, " ".join(STRANGE), "\n".join(STRANGE) + "é" * 9 + " ".join(STRANGE)]:
        b = t.encode()
        got = [(k, *s) for k, v in base_spans(b).items() for s in code_points(b, v)]
        assert got == brute(t), t[:60]


def test_query_shape_and_base_on_documents(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    for r in personal_data(docs).select("row.text", "n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans").collect():
        want = brute(r.text)
        assert (r.n_email, r.n_ip, r.n_card, r.n_phone) == tuple(sum(k == x for k, *_ in want) for x in PATTERNS)
        text = ",".join(f"{k}:{a}:{b}" for k, a, b in want)
        assert r.base_sha256 == hashlib.sha256(text.encode()).hexdigest()
        assert set(text.split(",")) - {""} <= set(r.spans.split(","))


def test_model_adds_what_patterns_miss_and_leaves_clean_text(spark):
    texts = ["please call (646) 555-0177 tonight", "In 1987 about 3,000 people came by 12 boats, see page 45.", "number 9807915762804490 is no card"]
    out = {r.doc_id: r.spans for r in personal_data(docs_of(spark, texts)).select("row.doc_id", "spans").collect()}
    assert out == {0: "phone:12:26", 1: "", 2: ""}
    clean = masked(personal_data(docs_of(spark, texts))).select("row.doc_id", "clean").collect()
    assert {r.doc_id: r.clean for r in clean}[0] == "please call <phone> tonight"


def viterbi(model, words):
    """Plain Viterbi over one line, for comparison."""
    p = [w.translate(C.PATTERN) for w in words]
    rows = [model.rows(x) for x in p]
    edge = model.rows(None)
    e = [rows[i][0] + (rows[i - 1] if i else edge)[1] + (rows[i + 1] if i + 1 < len(p) else edge)[2] for i in range(len(p))]
    score, back = model.start + e[0], []
    for x in e[1:]:
        m = score[:, None] + model.trans
        back.append(m.argmax(axis=0))
        score = m.max(axis=0) + x
    out = [int(score.argmax())]
    for b in reversed(back):
        out.append(int(b[out[-1]]))
    return out[::-1]


def test_batched_viterbi_equals_plain_and_the_bound_holds():
    model = C.train()
    d = C.Decoder(model)
    lines = [C.MARK.sub(r"\2", x).encode().split() for x in C.LABELLED] + [b"1.2.3.4 a@b.cd +1 (212) 555-0134 end".split(), [b"x"], []]
    words, ends = [w for x in lines for w in x], np.cumsum([len(x) for x in lines])
    got = d.decode(d.ids(words), ends)
    want = [y for x in lines if x for y in viterbi(model, x)]
    assert got.tolist() == want
    for x in lines:
        if x and not d.loud(d.ids(x)).any():
            assert not any(viterbi(model, x))
    quiet = [b"plain", b"words", b"only", b"here."]
    assert not d.loud(d.ids(quiet)).any()


def test_training_fits_and_repeats():
    a, b = C.train(), C.train()
    assert (a.weights == b.weights).all()
    d = C.Decoder(a)
    wrong = 0
    for x in C.LABELLED:
        words = C.MARK.sub(r"\2", x).encode().split()
        wrong += d.decode(d.ids(words), np.array([len(words)])).tolist() != C.parse(x)[1]
    assert wrong <= 2


def test_edges(spark):
    out = personal_data(edge_docs(spark)).collect()
    assert len(out) == len(edge_rows())
    by = {r.row.doc_id: r for r in out}
    assert by[1].spans == "" and (by[14].n_email, by[14].n_ip, by[14].n_card) == (1, 1, 1)
    assert personal_data(no_docs(spark)).count() == 0
