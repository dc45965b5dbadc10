"""Operator 10: toxicity by a bidirectional recurrent network.

Method: a bidirectional gated recurrent network with attention pooling, over
inputs made of word vectors and character-gram vectors, is trained in numpy on
a bounded sample of labelled documents, then sent to the workers, which score
all overlapping windows of every whole text; a document's score is its worst
window's.

Only the fit is bounded: at most TOXIC and CLEAN labelled rows, chosen by a
fixed hash of the id, never from rows held out. Language, source, id and label
are no inputs.

Defined results: null and empty texts get the score of a window without words;
repeated rows score alike; labels that are null or whose document is missing
are not used; without labels of both classes every score is the same constant;
an empty table gives an empty result; the caller's columns travel in one
struct, so none can clash.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from relcheck.llm import gru
from relcheck.llm.shared import arrow_pass, whole

#: Bound of the fit, in documents of each class.
TOXIC, CLEAN = 2500, 3500
THRESHOLD = 0.7


def held_out(key: Column) -> Column:
    """Rows never learnt from: crc32 of the id as text, modulo 3, is 1."""
    return F.coalesce(F.crc32(key.cast("string").cast("binary")) % 3 == 1, F.lit(False))


def labelled_sample(docs: DataFrame, labels: DataFrame, text: str = "text", key: str = "doc_id", label: str = "toxic",
                    toxic: int = TOXIC, clean: int = CLEAN) -> list[tuple[bytes, int]]:
    """(text, label) of a bounded sample of each class, in a fixed order. Ids
    are chosen first, so only the chosen texts move."""
    known = labels.where(F.col(f"`{key}`").isNotNull() & F.col(f"`{label}`").isin(0, 1) & ~held_out(F.col(f"`{key}`"))) \
                  .select(F.col(f"`{key}`").alias("id"), F.col(f"`{label}`").cast("int").alias("y")).distinct()
    order = F.md5(F.col("id").cast("string").cast("binary"))
    chosen = None
    for value, most in ((1, toxic), (0, clean)):
        part = known.where(F.col("y") == value).orderBy(order, "id").limit(most)
        chosen = part if chosen is None else chosen.unionByName(part)
    rows = whole(docs, text, id=F.col(f"`{key}`")).select("id", "body").join(chosen, "id").orderBy(order, "id", "y", F.md5("body")).limit(toxic + clean).collect()
    return [(bytes(r.body), r.y) for r in rows]


def toxicity(docs: DataFrame, labels: DataFrame, text: str = "text", key: str = "doc_id", label: str = "toxic",
             threshold: float = THRESHOLD, toxic: int = TOXIC, clean: int = CLEAN, carry: list[str] | None = None) -> DataFrame:
    """(row, held_out, score, predicted, window): ``window`` is the number of
    the 64-word window that gave the score (every 32 words one starts)."""
    sample = labelled_sample(docs, labels, text, key, label, toxic, clean)
    model = docs.sparkSession.sparkContext.broadcast(gru.train([t for t, _ in sample], [y for _, y in sample]))

    def work():
        scorer = gru.Scorer(model.value)

        def do(texts, _):
            scores, places = scorer.texts(texts)
            return [scores.astype("float64"), places]
        return do

    scored = arrow_pass(whole(docs, text, carry, held_out=held_out(F.col(f"`{key}`"))), "score double, window long", work, keep=["row", "held_out"])
    return scored.withColumn("predicted", (F.col("score") >= threshold).cast("int"))
