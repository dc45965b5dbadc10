"""Small tables with every awkward row, shared by the tests."""

from __future__ import annotations

import random

SCHEMA = ("doc_id long, text string, source string, lang string, n_chars long, row string, body string, id string, twin string, "
          "k string, size string, shard string, slot string, host string, n_words string, score string, copies string, `a b` string")
CLASH = ("r", "b", "i", "t", "k", "s", "sh", "sl", "h", "n", "sc", "c", "ab")

VOCAB = "alpha beta gamma delta lorem ipsum river stone cloud über naïve señor 東京 zebra quick brown fox jumps over lazy dog".split()


UPPER = str.maketrans("abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ")


def prose(seed: int, words: int, mark: str = "") -> str:
    r = random.Random(seed)
    out = []
    for i in range(words):
        w = r.choice(VOCAB) + (str(r.randrange(50)) if r.random() < 0.7 else "") + mark
        out.append(w + (". " if r.random() < 0.1 else ",\n" if r.random() < 0.03 else " "))
    return "".join(out).strip()


def edge_rows() -> list[tuple]:
    """(doc_id, text, source): nulls, empties, long texts, copies, repeats."""
    base = prose(1, 120)
    words = base.split(" ")
    near = " ".join(words[:50] + ["changed"] + words[51:])
    return [
        (1, None, "s1"), (2, "", "s1"), (3, " \n\t ", None), (4, "one", "s2"), (5, "one two three four", "s2"),
        (6, base, "s1"), (7, base, "s1"), (8, near, "s3"), (9, base.translate(UPPER), "s3"),
        (None, base, "s1"), (None, None, None), (10, "x" * 200_000, "s1"), (11, prose(2, 30_000), "s2"),
        (12, prose(3, 200), "s2"), (12, prose(4, 200), "s2"), (13, prose(5, 80), "s1"), (13, prose(5, 80), "s1"),
        (14, "+1 (212) 555-0134 a.b@c.example 1.2.3.4 card 4111 1111 1111 1111", "s4"), (15, "東京 über " * 40, "s4"),
    ]


def edge_docs(spark):
    rows = [(d, t, s, "en", None if t is None else len(t), *CLASH) for d, t, s in edge_rows()]
    return spark.createDataFrame(rows, SCHEMA)


def no_docs(spark):
    return spark.createDataFrame([], SCHEMA)


def docs_of(spark, texts, source="s"):
    """doc_id from 0 by place."""
    return spark.createDataFrame([(i, t, source) for i, t in enumerate(texts)], "doc_id long, text string, source string")
