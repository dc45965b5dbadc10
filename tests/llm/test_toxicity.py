import zlib

import numpy as np

from relcheck.llm import gru
from relcheck.llm.toxicity import labelled_sample, toxicity
from tests.llm.helpers import edge_docs, edge_rows, no_docs, prose


def corpus(n, seed=0, words=120):
    rows = []
    for i in range(n):
        t, bad = prose(seed + i, words), i % 3 == 0
        w = t.split(" ")
        if bad:
            for k in range(4):
                w[(7 * k + i) % len(w)] = ("grumble", "snarl", "hissing")[k % 3]
        rows.append((i, " ".join(w), "s", int(bad)))
    return rows


def test_held_out_accuracy_and_rule(spark):
    rows = corpus(400)
    docs = spark.createDataFrame([r[:3] for r in rows], "doc_id long, text string, source string")
    labels = spark.createDataFrame([(r[0], r[3]) for r in rows] + [(5, None), (None, 1), (9999, 1)], "doc_id long, toxic int")
    out = {r.row.doc_id: r for r in toxicity(docs, labels).collect()}
    assert all(r.held_out == (zlib.crc32(str(i).encode()) % 3 == 1) for i, r in out.items())
    test = [i for i in out if out[i].held_out]
    right = sum(out[i].predicted == rows[i][3] for i in test)
    assert right >= 0.95 * len(test) and all(0 <= r.score <= 1 for r in out.values())
    assert not {t for t, _ in labelled_sample(docs, labels)} & {rows[i][1].encode() for i in test}


def test_gradients_equal_differences():
    m = gru.Model.fresh()
    for k in m:
        m[k] = m[k].astype(np.float64)
    words, y, weight = [[b"hello", b"there", b"x"], [b"of"], []], np.array([1.0, 0.0, 1.0]), np.array([0.5, 0.3, 0.2])

    def loss():
        g, p = gru.gradients(m, words, y, weight)
        return -(weight * (y * np.log(p) + (1 - y) * np.log(1 - p))).sum(), g

    _, g = loss()
    for k in ("Wf", "Wb", "Uf", "Ub", "cf", "a", "o", "o0", "words", "grams"):
        at = np.unravel_index(np.abs(g[k]).argmax(), g[k].shape)
        m[k][at] += 1e-2
        up = loss()[0]
        m[k][at] -= 2e-2
        down = loss()[0]
        m[k][at] += 1e-2
        assert abs((up - down) / 2e-2 - g[k][at]) < 1e-3 * max(1e-2, abs(g[k][at])) + 1e-6, k


def test_fast_scores_equal_training_forward_over_all_windows():
    m = gru.Model.fresh(3)
    texts = [prose(i, n).encode() for i, n in enumerate((3, 64, 65, 200, 1000))] + [b"", b"   "]
    scores, places = gru.Scorer(m).texts(texts)
    for t, s, k in zip(texts, scores, places, strict=True):
        w = t.translate(gru.FOLD).split()
        starts = gru.window_starts(len(w))
        assert set(range(len(w))) <= {x for a in starts for x in range(a, a + gru.WINDOW)}
        p = gru.gradients(m, [w[a:a + gru.WINDOW] for a in starts], np.zeros(len(starts)), np.ones(len(starts), np.float32))[1]
        assert abs(p.max() - s) < 1e-4 and abs(p[k] - s) < 1e-4
    one = [gru.Scorer(m).texts([t])[0][0] for t in texts]
    assert np.allclose(one, scores, atol=1e-5)


def test_edges(spark):
    labels = spark.createDataFrame([(6, 1), (11, 0), (12, 0), (14, 1)], "doc_id long, toxic int")
    out = toxicity(edge_docs(spark), labels).collect()
    assert len(out) == len(edge_rows()) and all(0 <= r.score <= 1 for r in out)
    none = toxicity(edge_docs(spark), labels.limit(0)).collect()
    assert len({r.score for r in none}) == 1
    assert toxicity(no_docs(spark), labels).count() == 0


def test_a_passage_of_half_a_window_is_whole_in_some_window():
    half = gru.WINDOW // 2
    for n in (32, 40, 64, 65, 96, 200, 331):
        assert all(any(a <= at and at + half <= a + gru.WINDOW for a in gru.window_starts(n)) for at in range(n - half + 1))
