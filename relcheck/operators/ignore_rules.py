"""Ignore rules as a table of globs.

Thousands of rules are not tried on every name. Each rule has an anchor that any
name it matches must hold: the whole name, if the rule has no wildcard; else its
longest plain piece, whole. A piece stands at a fixed place from the start if only
wildcards of one letter come before it, from the end if only such come after it,
else anywhere. Names offer the same (themselves, their letters at the places and in
the lengths that rules ask for; for pieces that stand anywhere, only where a piece's
first letters are met), both meet by equality, and only pairs that met are matched
as globs. A rule without any plain letter ('*', '?[a-z]') has the empty anchor and is
tried on every name.
"""

from __future__ import annotations

import re

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from relcheck.functions.text import glob_to_regex

#: Letters by which a piece that stands anywhere is looked up first.
GRAM = 3
WILD = re.compile(r"\*+|\?|\[!?\]?[^\]]*\]")
WHOLE, HEAD, TAIL, PART = "whole", "head", "tail", "part"
ANCHOR = "how string, skip int, anchor string, sure boolean, regex string"


def anchor(glob: str) -> tuple[str, int, str, bool]:
    """(how, letters to skip from the start or end, anchor, whether meeting by
    the anchor is a match already)."""
    found = [m.span() for m in WILD.finditer(glob)]
    if not found:
        return WHOLE, 0, glob, True
    pieces = [(glob[a:b], i) for i, ((_, a), (b, _)) in enumerate(zip([(0, 0), *found], [*found, (len(glob), 0)], strict=True))]
    stars = [glob[a] == "*" for a, _ in found]

    def place(i: int) -> tuple[str, int]:
        if not any(stars[:i]):
            return HEAD, i + sum(len(p) for p, _ in pieces[:i])
        if not any(stars[i:]):
            return TAIL, len(found) - i + sum(len(p) for p, _ in pieces[i + 1:])
        return PART, 0

    longest = max(len(p) for p, _ in pieces)
    if not longest:
        return PART, 0, "", False
    (how, skip), piece = min(((place(i), p) for p, i in pieces if len(p) == longest), key=lambda x: x[0][0] == PART)
    return how, skip, piece, (how, skip, set(glob[longest:])) == (HEAD, 0, {"*"}) or (how, skip, set(glob[:-longest])) == (TAIL, 0, {"*"})


def compiled(rules: DataFrame, pattern: str = "pattern") -> DataFrame:
    """(pattern, how, skip, anchor, sure, regex): the distinct rules."""
    @F.pandas_udf(ANCHOR)
    def made(globs: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([(*anchor(g), glob_to_regex(g)) for g in globs], columns=["how", "skip", "anchor", "sure", "regex"])

    one = rules.select(F.col(pattern).alias("pattern")).where("pattern is not null").distinct()
    return one.select("pattern", made("pattern").alias("r")).select("pattern", "r.*")


def offered(name: Column, places: list[tuple[str, int, int]]) -> Column:
    """What a name can be met by: (how, skip, anchor), for each (how, skip,
    length) in ``places`` that lies within the name."""
    n = F.length(name)

    def pair(how: str, skip: int, c: Column) -> Column:
        return F.struct(F.lit(how).alias("how"), F.lit(skip).alias("skip"), c.alias("anchor"))

    out = [pair(WHOLE, 0, name)]
    for how, skip, k in places:
        start = F.lit(skip + 1) if how == HEAD else n - (skip + k - 1)
        out.append(F.when(n >= skip + k, pair(how, skip, F.substring(name, start, F.lit(k)))))
    return F.array_compact(F.array(*out))


def _inside(names: DataFrame, pieces: DataFrame) -> DataFrame:
    """(name, how, skip, anchor) for pieces that stand anywhere: the lengths asked
    for are looked up by a piece's first letters, at every place of a name."""
    asked = pieces.groupBy(F.substring("anchor", 1, GRAM).alias("gram")).agg(F.collect_set(F.length("anchor")).alias("lengths"))
    starts = F.sequence(F.lit(1), F.greatest(F.length("name"), F.lit(1)))
    at = names.select("name", F.explode(starts).alias("i"))
    grams = F.array_distinct(F.transform(F.sequence(F.lit(0), F.lit(GRAM)), lambda k: F.substring(F.col("name"), F.col("i"), k)))
    # the empty gram is offered once a name
    at = at.select("name", "i", F.explode(F.filter(grams, lambda g: (g != "") | (F.col("i") == 1))).alias("gram"))
    met = at.join(F.broadcast(asked), "gram").select("name", "i", F.explode("lengths").alias("k"))
    return met.where(F.col("i") + F.col("k") - 1 <= F.length("name")) \
        .select("name", F.lit(PART).alias("how"), F.lit(0).alias("skip"), F.substring("name", F.col("i"), F.col("k")).alias("anchor"))


def candidates(names: DataFrame, rules: DataFrame, pattern: str = "pattern") -> DataFrame:
    """(name, pattern, sure, regex): names and rules that met by an anchor, once for
    each way they met. To the driver come the places and lengths of anchors only."""
    ready = compiled(rules, pattern)
    places = ready.where(F.col("how").isin(HEAD, TAIL)).select("how", "skip", F.length("anchor").alias("k")).distinct().collect()
    one = names.select("name").where("name is not null").distinct()
    keyed = one.select("name", F.explode(offered(F.col("name"), sorted((r.how, r.skip, r.k) for r in places))).alias("o")).select("name", "o.*")
    keyed = keyed.unionByName(_inside(one, ready.where(F.col("how") == PART)))
    return keyed.join(ready, ["how", "skip", "anchor"]).select("name", "pattern", "sure", "regex")


def _met(names: DataFrame, rules: DataFrame, pattern: str) -> DataFrame:
    return candidates(names, rules, pattern).where(F.col("sure") | F.regexp_like("name", F.col("regex"))).select("name", "pattern")


def matches(names: DataFrame, rules: DataFrame, pattern: str = "pattern") -> DataFrame:
    """(name, pattern): which rules match which of ``names`` (``name``)."""
    return _met(names, rules, pattern).distinct()


def without_ignored(df: DataFrame, rules: DataFrame, schema_col: str = "table_schema", table_col: str = "table_name", pattern: str = "pattern") -> DataFrame:
    """``df`` without the rows whose ``schema.table`` any rule matches."""
    name = F.concat_ws(".", schema_col, table_col)
    gone = _met(df.select(name.alias("name")), rules, pattern).select(F.col("name").alias("_gone")).distinct()
    return df.join(gone, name == F.col("_gone"), "left_anti")
