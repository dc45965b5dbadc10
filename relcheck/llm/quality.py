"""Operator 8: quality rules with the host's record behind them.

Method: every document is measured against page rules; failures are summed by
host; each host's failure rate of each rule is shrunk towards all hosts' by a
beta prior fitted to the hosts themselves (method of moments); the host
verdicts are joined back. A document goes if it fails a base rule, or if it
fails a page rule that its host breaks habitually (shrunk rate at the limit or
over). A document that fails no rule stays whatever its host does, and one
page rule failed on a host without the habit is forgiven.

Defined results: null text has no words (and so fails the base rule); a null
host is a host of its own; repeated rows are measured and counted each; an
empty table gives an empty result; the caller's columns travel in one struct,
so none can clash. Whole texts are measured, in memory bounded by the longest.
"""

from __future__ import annotations

from collections import Counter

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from relcheck.llm.shared import arrow_pass, staged, whole

COUNTS = ["n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words"]
SYMBOLS = b"#*$%&|<>"
SPACES = b" \t\n\x0b\x0c\r"
#: All bytes but those that continue a code point of UTF-8.
NOT_INNER = bytes(b for b in range(256) if not 0x80 <= b < 0xC0)
#: A rule counts as a host's habit from this shrunk failure rate on.
HABIT = 0.05
#: The prior weighs as so many documents at least and at most.
PRIOR_LEAST, PRIOR_MOST = 10.0, 1e6


def measure(text: bytes) -> tuple[int, int, int, int, int, int]:
    """The counts of COUNTS, in this order, for one whole text."""
    words = text.split()
    dense = text.translate(None, SPACES)
    inner = 0 if dense.isascii() else len(dense.translate(None, NOT_INNER))
    lines = [x for x in text.split(b"\n") if x and not x.isspace()]
    runs = list(zip(words, words[1:], words[2:], strict=False))
    repeated = 0
    if len(set(runs)) < len(runs):
        often, covered = Counter(runs), 0  # covered: words up to here are counted
        for i, run in enumerate(runs):
            if often[run] > 1:
                repeated += i + 3 - max(i, covered)
                covered = i + 3
    return (len(words), len(dense) - inner, len(text) - len(text.translate(None, SYMBOLS)),
            len(lines), len(lines) - len(set(lines)), repeated)


def measured(docs: DataFrame, text: str = "text", host: str = "source") -> DataFrame:
    """(row, host, counts of COUNTS): one pass over the texts, no shuffle."""
    def work():
        return lambda texts, _: [list(c) for c in zip(*map(measure, texts), strict=True)] if texts else [[] for _ in COUNTS]

    return arrow_pass(whole(docs, text, host=F.col(f"`{host}`")), ", ".join(f"{c} long" for c in COUNTS), work, keep=["row", "host"])


def base_failed() -> Column:
    return (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))


def page_rules() -> dict[str, Column]:
    """Page rules, in whole numbers; true: the document fails."""
    c = F.col
    return {
        "word_length": (c("word_chars") < 3 * c("n_words")) | (c("word_chars") > 12 * c("n_words")),
        "symbols": 10 * c("n_symbols") > c("n_words"),
        "dup_lines": 10 * c("n_dup_lines") > 3 * c("n_lines"),
        "repeats": 100 * c("n_repeat_words") > 30 * c("n_words"),
    }


def host_record(counts: DataFrame) -> DataFrame:
    """host, n, and failures of every page rule; summed map-side first."""
    return counts.groupBy("host").agg(F.count("*").alias("n"), *[F.sum(v.cast("long")).alias(k) for k, v in page_rules().items()])


def priors(record: DataFrame) -> dict[str, tuple[float, float]]:
    """Beta prior (a, b) of each rule by the method of moments over all hosts:
    one row of sums comes back, however many hosts there are."""
    rules = list(page_rules())
    sums = record.agg(F.count("*").alias("hosts"), F.sum("n").alias("docs"), *[F.sum(r).alias(r) for r in rules],
                      *[F.sum(F.col(r).cast("double") * F.col(r) / F.col("n")).alias(f"{r}_sq") for r in rules]).first()
    out = {}
    for r in rules:
        n, h = float(sums.docs or 0), sums.hosts
        m = (sums[r] or 0) / n if n else 0.0
        if not 0 < m < 1 or h < 2:
            out[r] = (m * PRIOR_LEAST, (1 - m) * PRIOR_LEAST)
            continue
        # sum over hosts of n (p - m)^2; its mean is m (1-m) (1 + (n_mean - 1) / (s + 1)) for strength s
        spread = (sums[f"{r}_sq"] - n * m * m) / (h - 1) / (m * (1 - m))
        s = (n / h - 1) / (spread - 1) - 1 if spread > 1 else PRIOR_MOST
        s = min(max(s, PRIOR_LEAST), PRIOR_MOST)
        out[r] = (m * s, (1 - m) * s)
    return out


def host_verdicts(record: DataFrame, habit: float = HABIT) -> DataFrame:
    """host and one boolean a rule: the host breaks it habitually."""
    fitted = priors(record)
    return record.select(F.col("host").alias("of_host"), *[
        ((F.col(r) + a) / (F.col("n") + a + b) >= habit).alias(f"habit_{r}") for r, (a, b) in fitted.items()])


def with_verdict(counts: DataFrame, verdicts: DataFrame) -> DataFrame:
    """Left join on the host (null-safe). The verdict table has one row a
    host; the planner broadcasts it by its size, or splits a hot host."""
    joined = counts.join(verdicts, F.col("host").eqNullSafe(F.col("of_host")), "left")
    rejected = F.lit(False)
    for r, failed in page_rules().items():
        rejected = rejected | (failed & F.coalesce(F.col(f"habit_{r}"), F.lit(False)))
    return (joined.withColumn("base_failed", base_failed()).withColumn("host_rejected", rejected)
            .withColumn("kept", ~(F.col("base_failed") | F.col("host_rejected"))).drop("of_host"))


def quality(docs: DataFrame, text: str = "text", host: str = "source", keys: tuple[str, ...] = ("doc_id",),
            habit: float = HABIT) -> DataFrame:
    """(keys..., host, counts, habits, base_failed, host_rejected, kept): one
    row a document. The counts are staged once (narrow), summed, joined back."""
    counts = staged(measured(docs, text, host).select(F.struct(*[F.col(f"row.`{k}`") for k in keys]).alias("key"), "host", *COUNTS), "quality")
    verdicts = staged(host_verdicts(host_record(counts), habit), "verdicts")
    return with_verdict(counts, verdicts)


def keep_good(docs: DataFrame, text: str = "text", host: str = "source", habit: float = HABIT) -> DataFrame:
    """The documents that stay, with their own columns only. Texts are
    measured a second time beside the small verdict table, not shuffled."""
    verdicts = staged(host_verdicts(host_record(measured(docs, text, host).drop("row")), habit), "verdicts")
    return with_verdict(measured(docs, text, host), verdicts).where("kept").select("row.*")
