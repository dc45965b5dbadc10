import random
from collections import Counter

import public_tokenizers
from tokenizers import Tokenizer

from relcheck.llm.token_counts import PRE_TOKEN, SAFE, Lengths, counter, frequent_table, frequent_words, token_counts, trimmed
from tests.conftest import SF
from tests.llm.helpers import docs_of, edge_docs, edge_rows, no_docs

PATH = public_tokenizers.path("byte_bpe_50k.json")
JSON = open(PATH, encoding="utf-8").read()


def library():
    t = Tokenizer.from_str(JSON)
    return lambda s: len(t.encode(s or "", add_special_tokens=False).ids)


def test_equals_library_on_documents(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    want = library()
    out = token_counts(docs, PATH).select("row.text", "n_bytes", "n_tokens", "over_limit").collect()
    assert len(out) == docs.count()
    for r in out:
        assert (r.n_bytes, r.n_tokens, r.over_limit) == (len((r.text or "").encode()), want(r.text), want(r.text) > 512)


def test_equals_library_on_strange_strings():
    r, want, count = random.Random(1), library(), counter(JSON, frequent_table(JSON, ["the", "don't", "x1y", "a"]))
    pieces = ["'s", "'re", "''", " ", "  ", "\n", "\t", "\x0b", "\x1c", "\x85", "\xa0", "　", "a", "Ä", "ß", "東", "ⅷ", "٣", "7", "12", "½", "²",
              "_", "!", "?!", "é", "é", "😀", "👨‍👩‍👧", "​", " ", "<|endoftext|>", "<|endof", "İ", "ǆ", "ൎ", "ꟲ", "𞤀", "x" * 70, "\r\n"]
    for _ in range(3000):
        s = "".join(r.choice(pieces) for _ in range(r.randrange(12)))
        assert count(s) == want(s), repr(s)


def test_every_character_of_the_plain_range():
    import regex
    from relcheck.llm.token_counts import UNUSUAL
    want, count = library(), counter(JSON, ("", b""))
    plain = [chr(c) for c in range(0x3000) if not UNUSUAL.search(chr(c))]
    for c in plain:
        for s in (c, f"a{c}b", f" {c} 1", f"{c}{c} x"):
            assert count(s) == want(s), repr(s)
    assert regex.compile(PRE_TOKEN)


def test_cache_is_bounded(monkeypatch):
    import relcheck.llm.token_counts as m
    monkeypatch.setattr(m, "CACHE_ENTRIES", 10)
    lengths = Lengths(Tokenizer.from_str(JSON), frequent_table(JSON, ["the", "of"]))
    for i in range(100):
        lengths[f" word{i}"]
        assert len(lengths) <= 12
    assert lengths[" the"] == 1


def test_frequent_words_of_the_corpus(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").repartition(4)
    counts = Counter(w for r in docs.collect() for w in (r.text or "").encode().split())
    words = frequent_words(docs)
    # a word that a task saw once is not in its summary, so counts may be a little less
    assert [w.encode() for w in words[:20]] == sorted(counts, key=lambda w: (-counts[w], w))[:20]
    assert {w for w, n in counts.items() if n > 9 and len(w) <= 48} <= {w.encode() for w in words}
    names, sizes = frequent_table(JSON, words)
    assert max(sizes) > 1 and len(names.split("\0")) == len(sizes)
    want = library()
    assert all(want(w) == n for w, n in zip(names.split("\0"), sizes, strict=True))
    # with small summaries: still all that is frequent in every part
    assert {w for w, n in counts.most_common(5)} <= {w.encode() for w in frequent_words(docs, held=400, most=300)}
    assert len(frequent_words(docs, held=50, most=7)) == 7 and frequent_words(no_docs(spark)) == []


def test_summary_keeps_what_is_frequent():
    r = random.Random(3)
    words = [b"hot"] * 3000 + [b"warm"] * 1500 + [b"w%d" % r.randrange(4000) for _ in range(8000)]
    r.shuffle(words)
    counts: Counter = Counter()
    for at in range(0, len(words), 100):
        counts.update(words[at:at + 100])
        if len(counts) > 40:
            counts = trimmed(counts, 10)
    top = trimmed(counts, 10)
    assert len(top) <= 10 and {b"hot", b"warm"} <= set(top) and all(n <= words.count(w) for w, n in top.items())


def test_long_texts_of_other_scripts(spark):
    r = random.Random(5)
    scripts = ["Привет мир, это текст.", "Καλημέρα κόσμε", "東京の天気は晴れです。", "مرحبا بالعالم", "हिन्दी में पाठ", "plain words here,", "emoji 😀👍 too", "tab\there", "two  spaces", "no\u00a0break", "a ́b", "don't"]
    texts = [" ".join(r.choice(scripts) for _ in range(3000)), scripts[0] * 3000, scripts[2] * 3000, "words and words " * 2000 + "Ж" + " and more" * 2000]
    texts += [" ".join(r.choice(scripts) for _ in range(r.randrange(1, 9))) for _ in range(300)]
    want = library()
    out = token_counts(docs_of(spark, texts), PATH).select("row.doc_id", "n_tokens").collect()
    assert len(out) == len(texts) and all(x.n_tokens == want(texts[x.doc_id]) for x in out)
    assert SAFE.split("a Ж b c") == ["a Ж b", " c"]


def test_edges(spark):
    want = library()
    out = token_counts(edge_docs(spark), PATH).select("row.doc_id", "row.text", "n_bytes", "n_tokens").collect()
    assert len(out) == len(edge_rows()) and all(r.n_tokens == want(r.text) for r in out)
    assert token_counts(no_docs(spark), PATH).count() == 0
    assert token_counts(docs_of(spark, ["the cat"]), PATH, frequent=[], carry=["doc_id"]).select("row.*", "n_tokens").first().n_tokens == 2
