"""Operator 4: personal data by patterns and a conditional random field.

Method: a linear-chain CRF over word-shape features is trained once, on the
driver, from a small labelled table, and sent to the workers; it decodes every
line of every whole text by Viterbi in numpy batches. The stated base patterns
are searched as well; their spans always stay. A span of the CRF is added where
it overlaps no base span: forms the patterns do not know, such as a telephone
number without its plus sign.

Defined results: null and empty texts have no spans; rows are treated one by
one, so repeats, ties and empty tables need no care; overlapping CRF spans
cannot occur; the caller's columns travel in one struct, so none can clash.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from relcheck.llm import crf as C
from relcheck.llm.pii_rules import KINDS, NOT_DIGIT, base_spans, code_points, ips, luhn, written
from relcheck.llm.substring_dedup import WORDS
from relcheck.llm.shared import arrow_pass, whole

#: Marks around a value that do not belong to it.
LEAD, TRAIL = b"\"'<[{", b".,;:!?\"'>]}"
#: A card or telephone number has so many digits, an IP address four parts.
DIGITS = {"card": (13, 19), "phone": (7, 15)}


def labels_of(text: bytes, decoder: C.Decoder) -> np.ndarray:
    """Labels of a text's words; its lines are decoded together."""
    words, ends = [], []
    for line in text.split(b"\n"):
        words += line.split()
        ends.append(len(words))
    return decoder.decode(decoder.ids(words), np.array(ends, np.int64))


def crf_spans(text: bytes, labels: np.ndarray) -> list[tuple[str, int, int]]:
    """(kind, start, end) in bytes of the labelled words of one text."""
    places = [m.span() for m in WORDS.finditer(text)]
    out, i = [], 0
    while i < len(labels):
        name = C.LABELS[labels[i]]
        if name == "O":
            i += 1
            continue
        kind, j = name[2:], i + 1
        while j < len(labels) and C.LABELS[labels[j]] == "I-" + kind:
            j += 1
        a, b = places[i][0], places[j - 1][1]
        while a < b and text[a] in LEAD:
            a += 1
        while b > a and text[b - 1] in TRAIL:
            b -= 1
        value = text[a:b]
        n = len(value.translate(None, NOT_DIGIT))
        if a < b and (kind not in DIGITS or DIGITS[kind][0] <= n <= DIGITS[kind][1]) and (kind != "card" or luhn(value.translate(None, NOT_DIGIT))) \
                and (kind != "ip" or ips(value)) and (kind != "email" or b"@" in value):
            out.append((kind, a, b))
        i = j
    return out


def find(texts: list[bytes], decoder: C.Decoder) -> list[list]:
    """Per text: four counts of base spans, their digest, all spans."""
    words, of = [], []
    for t in texts:
        words += t.split()
        of.append(len(words))
    busy = np.zeros(len(words) + 1, np.int64)
    np.cumsum(decoder.loud(decoder.ids(words)), out=busy[1:])
    del words
    out, at = [], 0
    for t, end in zip(texts, of, strict=True):
        base = base_spans(t)
        more: dict[str, list[tuple[int, int]]] = {k: [] for k in KINDS}
        if busy[end] > busy[at]:
            taken = [s for v in base.values() for s in v]
            for kind, a, b in crf_spans(t, labels_of(t, decoder)):
                if not any(x < b and a < y for x, y in taken):
                    more[kind].append((a, b))
        at = end
        pairs = sorted({s for d in (base, more) for v in d.values() for s in v})
        place = dict(zip(pairs, code_points(t, pairs), strict=True))
        base = {k: [place[s] for s in v] for k, v in base.items()}
        full = {k: base[k] + [place[s] for s in more[k]] for k in KINDS}
        out.append([*(len(base[k]) for k in KINDS), hashlib.sha256(written(base).encode()).hexdigest(), written(full)])
    return [list(c) for c in zip(*out, strict=True)] if out else [[] for _ in range(6)]


def personal_data(docs: DataFrame, text: str = "text", labelled: tuple[str, ...] = C.LABELLED, carry: list[str] | None = None) -> DataFrame:
    """(row, n_email, n_ip, n_card, n_phone, base_sha256, spans). ``labelled``:
    lines with marked spans such as ``[phone:555-0134]``; its size bounds the
    training and the broadcast model."""
    model = docs.sparkSession.sparkContext.broadcast(C.train(labelled))

    def work():
        decoder = C.Decoder(model.value)

        def do(texts: list[bytes], _: pa.RecordBatch) -> list[list]:
            return find(texts, decoder)
        return do

    return arrow_pass(whole(docs, text, carry), "n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string", work, keep=["row"])


def masked(found: DataFrame, text: str = "text") -> DataFrame:
    """``personal_data``'s rows with ``clean``: every span replaced by its
    kind in angle brackets, overlapping spans by the first one's."""
    def work():
        def do(texts, rows):
            out = []
            for t, spans in zip(texts, rows.column("spans").to_pylist(), strict=True):
                chars, at, left = t.decode("utf-8", "replace"), 0, []
                for a, b, kind in sorted((int(a), int(b), k) for k, a, b in (s.split(":") for s in spans.split(",") if s)):
                    if a >= at:
                        left += [chars[at:a], f"<{kind}>"]
                        at = b
                out.append("".join([*left, chars[at:]]))
            return [out]
        return do

    bodies = found.withColumn("body", F.coalesce(F.col(f"row.`{text}`"), F.lit("")).cast("binary"))
    return arrow_pass(bodies, "clean string", work, keep=found.columns)
