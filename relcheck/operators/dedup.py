"""Lookup de-duplication before a join (H1-H4).

``keep_first`` is the ROW_NUMBER()=1 rule expressed as an aggregate:
``min_by(row, order)`` per key is computed partially on each map task
before the shuffle, so a key holding a third of all rows costs one row per
task instead of one task sorting that whole key (what a window would do).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from relcheck.operators.constraints import duplicate_keys


def keep_first(df: DataFrame, key: list[str], order: list[str]) -> DataFrame:
    """H1: one row per business key, the first by ``order`` (ties broken by
    the remaining columns, so the result is deterministic)."""
    rest = [c for c in df.columns if c not in key]
    tie = [c for c in rest if c not in order]
    ordering = F.struct(*[F.col(c) for c in order + tie])
    return df.groupBy(*key).agg(F.min_by(F.struct(*rest), ordering).alias("_r")).select(*key, "_r.*")


def distinct_rows(df: DataFrame) -> DataFrame:
    """H2: DISTINCT (hash aggregate with map-side combine)."""
    return df.dropDuplicates()


def duplicate_report(df: DataFrame, key: list[str]) -> DataFrame:
    """H4: business keys with more than one row."""
    return duplicate_keys(df, key, skip_null_keys=False)


def join_deduplicated(facts: DataFrame, lookup: DataFrame, fact_key: list[str],
                      lookup_key: list[str], order: list[str]) -> DataFrame:
    """H3: facts left-joined to the de-duplicated lookup: the result has
    exactly one row per fact row."""
    first = keep_first(lookup, lookup_key, order)
    cond = [facts[f] == first[l] for f, l in zip(fact_key, lookup_key)]
    return facts.join(first, cond, "left")
