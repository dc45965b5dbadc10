"""Operator 6: benchmark decontamination by a generalised suffix automaton.

Method: the normalised words of the test items make one suffix automaton; every
document's words stream through it, which gives the length of the longest item
run that ends at each word; windows of N_WORDS item words (or a shorter item
as a whole) are hits. Hit spans are cut out; a document that is mostly hits
goes as a whole.

The items are worked on in blocks of at most BLOCK_WORDS words, so the
automaton that is broadcast is bounded however large the benchmark grows; long
items are cut into pieces that overlap by a window less one word. Each block is
one pass over the documents; only the hits of later blocks are kept and
joined to the first pass. Words not in any item end a match, so only stretches
of item words are streamed.

Defined results: null and empty texts have no words and are never hit; items
without words have no windows; items that repeat an id are one item; a null item
id is written 'null'; an empty benchmark hits nothing; repeated rows are treated
alike; an empty table gives an empty result; the caller's columns travel in
one struct, so none can clash.
"""

from __future__ import annotations

import hashlib
import re

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from relcheck.llm.automaton import Automaton
from relcheck.llm.shared import arrow_pass, row_of, staged, whole

N_WORDS, BLOCK_WORDS = 10, 60_000
#: Documents go as a whole when more than this share of their words is hit.
MOST_COVERED = 0.5
#: Capitals to small letters, all other bytes outside 0-9, a-z and the ones
#: above ASCII to spaces; a word is what is left together.
FOLD = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))
RUN = re.compile(rb"[^\x20]+")


def words_of(text: bytes) -> list[bytes]:
    return text.translate(FOLD).split()


def item_blocks(benchmark: DataFrame, n: int, text: str, item: str, block_words: int):
    """The benchmark as lists of (item id, words), a bounded block at a time.
    Distinct pieces are dealt to blocks by the hash of item and words, as many
    as the words ask for; a block of more than ``block_words`` is split."""
    def work():
        def do(texts, _):
            out = []
            for t in texts:
                ws, step = words_of(t), max(1, block_words // 4)
                out.append([" ".join(w.decode("utf-8", "replace") for w in ws[i:i + step + n - 1]) for i in range(0, max(1, len(ws) - n + 1), step)] if ws else [])
            return [out, [len(words_of(t)) for t in texts]]
        return do

    rows = whole(benchmark, text, item=F.coalesce(F.col(f"`{item}`").cast("string"), F.lit("null"))).drop("row")
    pieces = arrow_pass(rows, "pieces array<string>, n long", work, keep=["item"]).select("item", F.explode("pieces").alias("words")).distinct()
    pieces = staged(pieces.withColumn("n", F.size(F.split("words", " "))), "pieces")
    total = pieces.agg(F.sum("n")).first()[0] or 0
    blocks = max(1, -(-2 * total // block_words))
    pieces = pieces.withColumn("h", F.xxhash64("item", "words"))
    size = [F.sum("n").alias("size"), F.count("*").alias("k")]
    todo = [(blocks, *r) for r in pieces.groupBy(F.pmod("h", F.lit(blocks))).agg(*size).collect()]
    if not todo:
        yield []
    while todo:
        of, b, held, k = todo.pop()
        part = pieces.where(F.pmod("h", F.lit(of)) == b)
        if held > block_words and k > 1 and of < 1 << 61:
            todo += [(2 * of, *r) for r in part.groupBy(F.pmod("h", F.lit(2 * of))).agg(*size).collect()]
        else:
            yield [(r.item, r.words.encode().split()) for r in part.select("item", "words").collect()]


def scanned(rows: DataFrame, block: list[tuple[str, list[bytes]]], n: int, keep: list[str], hits_only: bool = False) -> DataFrame:
    """keep + (n_words, longest, items, spans as words from-to)."""
    shared = rows.sparkSession.sparkContext.broadcast((block, n))

    def work():
        machine = Automaton(*shared.value)

        def do(texts: list[bytes], _: pa.RecordBatch) -> list[list]:
            out = [[], [], [], []]
            for t in texts:
                ws = words_of(t)
                spans, found, longest = machine.scan(ws) if machine.least else ([], set(), 0)
                for column, v in zip(out, (len(ws), longest, sorted(found), [{"a": a, "b": b} for a, b in spans]), strict=True):
                    column.append(v)
            return out
        return do

    out = arrow_pass(rows, "n_words long, longest int, items array<string>, spans array<struct<a:int,b:int>>", work, keep=keep)
    return out.where(F.size("items") > 0) if hits_only else out


def contamination(docs: DataFrame, benchmark: DataFrame, text: str = "text", key: str = "doc_id", item_text: str = "text",
                  item: str = "item_id", n: int = N_WORDS, block_words: int = BLOCK_WORDS, carry: list[str] | None = None) -> DataFrame:
    """(row, body, n_words, n_hit, longest, items, spans): ``spans`` are runs of
    hit words, from-to, in order and apart; ``items`` the ids, sorted."""
    rows = docs.select(row_of(docs, carry), F.col(f"`{key}`").alias("id"),
                       F.coalesce(F.col(f"`{text}`"), F.lit("")).cast("binary").alias("body")).withColumn("twin", F.xxhash64("body"))
    out, more = None, None
    for block in item_blocks(benchmark, n, item_text, item, block_words):
        if out is None:
            out = scanned(rows, block, n, ["row", "body", "id", "twin"])
            continue
        hits = staged(scanned(rows.select("id", "twin", "body"), block, n, ["id", "twin"], hits_only=True).drop("n_words").distinct(), "hits")
        more = hits if more is None else more.unionByName(hits)
    if more is not None:
        late = more.groupBy("id", "twin").agg(F.max("longest").alias("longest2"), F.flatten(F.collect_list("items")).alias("items2"),
                                              F.flatten(F.collect_list("spans")).alias("spans2"))
        late = late.withColumnsRenamed({"id": "of", "twin": "of_twin"})
        out = out.join(late, F.col("id").eqNullSafe(F.col("of")) & (F.col("twin") == F.col("of_twin")), "left")
        out = (out.withColumn("longest", F.greatest("longest", "longest2"))
               .withColumn("items", F.array_sort(F.array_distinct(F.concat("items", F.coalesce("items2", F.array().cast("array<string>"))))))
               .withColumn("spans", apart(F.concat("spans", F.coalesce("spans2", F.array().cast("array<struct<a:int,b:int>>"))))))
    hit = F.aggregate("spans", F.lit(0).cast("long"), lambda s, x: s + x["b"] - x["a"])
    return out.select("row", "body", "n_words", hit.alias("n_hit"), "longest", "items", "spans")


def apart(spans):
    """Spans in order, those that touch or overlap made one."""
    empty = F.array().cast("array<struct<a:int,b:int>>")
    def add(done, x):
        last = F.try_element_at(done, F.lit(-1))
        return F.when((F.size(done) > 0) & (last["b"] >= x["a"]),
                      F.concat(F.slice(done, 1, F.size(done) - 1), F.array(F.struct(last["a"].alias("a"), F.greatest(last["b"], x["b"]).alias("b"))))) \
                .otherwise(F.concat(done, F.array(x)))
    return F.aggregate(F.array_sort(spans), empty, add)


def items_digest(items):
    return F.sha2(F.concat_ws(",", items).cast("binary"), 256)


def cut(text: bytes, spans: list[tuple[int, int]]) -> bytes:
    """The text without the words of the spans and what stands between them."""
    places = [m.span() for m in RUN.finditer(text.translate(FOLD))]
    out, at = [], 0
    for a, b in spans:
        out.append(text[at:places[a][0]])
        at = places[b - 1][1]
    out.append(text[at:])
    return b"".join(out)


def decontaminated(docs: DataFrame, benchmark: DataFrame, text: str = "text", key: str = "doc_id", item_text: str = "text",
                   item: str = "item_id", n: int = N_WORDS, most: float = MOST_COVERED, counts: tuple[str, ...] = ()) -> DataFrame:
    """The documents without hit spans, own columns; those with more than
    ``most`` of their words hit are left out. ``counts``: columns of the caller
    that hold the text's length in code points, set anew where it changed."""
    found = contamination(docs, benchmark, text, key, item_text, item, n).where(F.col("n_hit") <= most * F.col("n_words"))

    def work():
        def do(texts, rows):
            return [[cut(t, [(s["a"], s["b"]) for s in spans]).decode("utf-8", "replace") if spans else None
                     for t, spans in zip(texts, rows.column("spans").to_pylist(), strict=True)]]
        return do

    cleaned = arrow_pass(found, "clean string", work, keep=["row"])
    new = {text: F.coalesce("clean", F.col(f"row.`{text}`"))} | {c: F.when(F.col("clean").isNull(), F.col(f"row.`{c}`")).otherwise(F.length("clean")).cast(docs.schema[c].dataType) for c in counts}
    return cleaned.select(*[new.get(c, F.col(f"row.`{c}`")).alias(c) for c in docs.columns])
