"""Operator 9: mixing sources to target weights by hash thresholds.

Method: every document has a fixed hash; words are summed by source and hash
bucket; a source's budget of r times its own words is met by taking every
document floor(r) times and those below a hash threshold once more, so the
selections of growing budgets are nested. The threshold is found in the
histogram: the bucket where the running sum passes the budget is cut into finer
buckets, round by round, and only its rows are read again, until one hash is
left. Documents are then filtered by comparison; nothing is sorted.

Target shares are filled like vessels: each source gets its weight's part of
all words, at most ``most`` times its own words; what is over goes to the rest
by weight until none overflows. Numbers of iterations, not tables, come to the
driver, so the number of sources is not bounded.

Defined results: null text has size 0; null sources are one source, ranked
last; rows with equal id and text share one hash and are taken alike; an
empty table gives an empty result; sources of size 0 have target 0; the
caller's columns travel in one struct, so none can clash.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from relcheck.llm.shared import WORD, row_of, staged
from relcheck.llm.sharding import BITS, STEP, sort_key

#: Weights by rank of the source (code-point order, null last), repeating.
WEIGHTS = (5, 2, 1)
#: A source is taken so many times over at most.
MOST = 3


def words_of(text: str = "text") -> Column:
    """Number of words of the text (null: 0)."""
    return F.coalesce(F.regexp_count(F.col(f"`{text}`"), F.lit(WORD)), F.lit(0)).cast("long")


def ranked(sources: DataFrame) -> DataFrame:
    """sources (source, own) with ``rank`` from 0 by code point, null last.
    Ranges are numbered apart and offset by the counts of those before, so no
    task gets all sources; staged first, so reruns see the same ranges."""
    ranges = staged(sources.withColumn("last", F.col("source").isNull()).repartitionByRange("last", "source")
                    .withColumn("part", F.spark_partition_id()), "ranges")
    parts = ranges.groupBy("part").agg(F.count("*").alias("n"))
    parts = parts.select(F.col("part").alias("of_part"), (F.sum("n").over(Window.orderBy("part")) - F.col("n")).alias("before"))
    own = F.row_number().over(Window.partitionBy("part").orderBy("last", "source"))
    return ranges.withColumn("place", own).join(F.broadcast(parts), F.col("part") == F.col("of_part")) \
                 .select("source", "own", (F.col("before") + F.col("place") - 1).alias("rank"))


def targets(sources: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST) -> DataFrame:
    """(source, own, target): own and target in words. Each round reads one
    row: the words of the full sources and the weight of the others."""
    weight = F.element_at(F.array(*[F.lit(w) for w in weights]), (F.col("rank") % len(weights) + 1).cast("int")).cast("long")
    table = staged(ranked(sources).withColumn("weight", weight), "sources")
    total = table.agg(F.sum("own")).first()[0] or 0
    full, level = F.lit(False), F.lit(0.0)
    n_full, left, open_weight = -1, total, None
    while True:
        row = table.agg(F.sum(F.when(full, most * F.col("own")).otherwise(0)).alias("taken"),
                        F.sum(F.when(full, 0).otherwise(F.col("weight"))).alias("open"),
                        F.sum(full.cast("long")).alias("n_full")).first()
        left, open_weight = total - (row.taken or 0), row.open or 0
        if row.n_full is None or row.n_full == n_full or not open_weight:
            break
        n_full = row.n_full
        level = F.col("weight") * F.lit(left).cast("long") / F.lit(open_weight).cast("double")
        exact = "decimal(18,0)"
        full = F.col("weight").cast(exact) * F.lit(left).cast(exact) > (most * F.col("own")).cast(exact) * F.lit(open_weight).cast(exact)
    return table.select("source", "own", F.when(full, (most * F.col("own")).cast("double")).otherwise(level).alias("target"))


def thresholds(docs: DataFrame, budgets: DataFrame) -> DataFrame:
    """(source, below): rows of ``docs`` (source, size, k) with k < below come
    nearest to the source's ``budget`` in words. Buckets of 12 more bits a
    round; only the boundary bucket of a source is refined."""
    todo = budgets.select(F.col("source").alias("of"), F.col("budget"), F.lit(0).cast("long").alias("before"),
                          F.lit(0).cast("long").alias("parent"))
    done, bits = None, 0
    while bits < BITS:
        bits += STEP
        inside = F.col("source").eqNullSafe(F.col("of")) & (F.shiftright("k", BITS - bits + STEP) == F.col("parent"))
        rows = docs if bits == STEP else docs.join(todo.select("of", "parent"), inside, "left_semi")
        cells = (rows.groupBy("source", F.shiftright("k", BITS - bits).alias("cell"))
                 .agg(F.sum("size").alias("words"), F.min("k").alias("low"), F.max("k").alias("high")))
        run = Window.partitionBy("source", "parent").orderBy("cell")
        cells = (cells.join(todo, F.col("source").eqNullSafe(F.col("of")) & (F.shiftright("cell", STEP) == F.col("parent")))
                 .withColumn("upto", F.col("before") + F.sum("words").over(run)))
        # the first bucket that passes the budget holds the boundary
        hit = (cells.where(F.col("upto") > F.col("budget"))
               .groupBy("source", "budget").agg(F.min_by(F.struct("cell", "upto", "words", "low", "high"), F.col("cell")).alias("c"))
               .select("source", "budget", "c.*"))
        hit = staged(hit, f"boundary{bits}")
        single = (F.col("low") == F.col("high")) | F.lit(bits >= BITS)
        nearer = 2 * (F.col("budget") - (F.col("upto") - F.col("words"))) >= F.col("words")  # the boundary document counts in or out
        ended = hit.where(single).select("source", F.when(nearer, F.col("high") + 1).otherwise(F.col("low")).alias("below"))
        done = ended if done is None else done.unionByName(ended)
        rest = hit.where(~single)
        if rest.isEmpty():
            break
        todo = rest.select(F.col("source").alias("of"), "budget", (F.col("upto") - F.col("words")).alias("before"), F.col("cell").alias("parent"))
    return done


def plan(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST) -> DataFrame:
    """docs (source, size, k) -> one row a source: source, own, target, whole
    (times every document is taken) and below (hash threshold of one more)."""
    sources = docs.groupBy("source").agg(F.sum("size").alias("own"))
    goal = targets(sources, weights, most)
    times = F.when(F.col("own") == 0, F.lit(0)).otherwise(F.floor(F.col("target") / F.col("own"))).cast("long")
    goal = staged(goal.withColumn("whole", F.least(times, F.lit(most).cast("long"))).withColumn("budget", F.col("target") - F.col("whole") * F.col("own")), "goal")
    found = staged(thresholds(docs, goal.where(F.col("budget") > 0)), "thresholds").withColumnRenamed("source", "of")
    return goal.join(found, F.col("source").eqNullSafe(F.col("of")), "left").select("source", "own", "target", "whole", F.coalesce("below", F.lit(0).cast("long")).alias("below"))


def mix(docs: DataFrame, text: str = "text", source: str = "source", key: str = "doc_id", weights: tuple[int, ...] = WEIGHTS,
        most: int = MOST, carry: list[str] | None = None) -> DataFrame:
    """(row, size, source_size, target, copies): ``row`` has the caller's
    columns (or those in ``carry``); take it ``copies`` times. The plan has one
    row a source; the planner broadcasts it by its size or splits a hot one."""
    rows = docs.select(row_of(docs, carry), F.col(f"`{source}`").alias("source"),
                       words_of(text).alias("size"), sort_key(F.col(f"`{key}`"), F.col(f"`{text}`")).alias("k"))
    narrow = staged(rows.select("source", "size", "k"), "sizes")
    by_source = plan(narrow, weights, most).withColumnRenamed("source", "of")
    copies = F.col("whole") + F.when(F.col("k") < F.col("below"), 1).otherwise(0)
    return (rows.join(staged(by_source, "plan"), F.col("source").eqNullSafe(F.col("of")))
            .select("row", "size", F.col("own").alias("source_size"), "target", copies.alias("copies")))


def mixed(docs: DataFrame, text: str = "text", source: str = "source", key: str = "doc_id", weights: tuple[int, ...] = WEIGHTS,
          most: int = MOST) -> DataFrame:
    """The mix itself: every document as often as it is taken, own columns."""
    taken = mix(docs, text, source, key, weights, most).where("copies > 0")
    return taken.select("row", F.explode(F.array_repeat(F.lit(1), F.col("copies").cast("int"))).alias("_")).select("row.*")
