"""Canonical document comparison (C15, C16), re-aimed to rows.

A JSON document becomes (doc_id, path, value) leaf rows. Object members give
paths joined with '.', a '.', '[', ']' or '\\' inside a name behind a '\\', so that
two places never share a path; a list is order-free, its elements compared as
wholes: path '[]' and the element's canonical text (object members sorted, inner
lists sorted, ignored keys dropped, text of normalised keys collapsed). Empty
objects and lists are leaves of their own, and every member of a repeated key
counts. Numbers are compared by value (1, 1.0 and 10e-1 are one). A text that is no JSON document is one leaf
at '$' with the text itself, so it differs from any other. There is no depth
limit of ours: what the JSON parser cannot nest counts as unparsable.

Two document sets are compared in three steps: the raw texts by hash, in the
JVM; the canonical texts of the documents that differ so, by hash; the leaves of
those that still do, as multisets. Where leaves say nothing although the texts
differ, that is a finding of its own, so no two different documents are equal.
"""

from __future__ import annotations

import decimal
import json
import re
import sys
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from relcheck.operators.findings import FINDINGS_COLS

WS = re.compile(r"[ \t\n\r\f\v]+")
LEAF = "array<struct<path:string,value:string>>"


NAME = re.compile(r"([.\[\]\\])")
#: Exponents up to which a number is written out.
PLAIN = 40


class _Number(str):
    """A number as it is written."""


class _Members(list):
    """The (name, value) pairs of an object, in order, repeats included."""


def _parse(text: str):
    return json.loads(text, parse_int=_Number, parse_float=_Number, parse_constant=_Number, object_pairs_hook=_Members)


def _number(text: str) -> str:
    """One text for equal values, exact for any number of digits."""
    try:
        sign, digits, exponent = decimal.Decimal(text).as_tuple()
        whole = "".join(map(str, digits)).rstrip("0").lstrip("0")
        exponent += len(digits) - len("".join(map(str, digits)).rstrip("0"))
    except (decimal.InvalidOperation, TypeError):  # NaN, Infinity, an exponent beyond any
        return text
    if not whole:
        return "0"
    minus = "-" * sign
    if abs(exponent) > PLAIN:
        return f"{minus}{whole}E{exponent}"
    if exponent >= 0:
        return minus + whole + "0" * exponent
    whole = whole.rjust(1 - exponent, "0")
    return f"{minus}{whole[:exponent]}.{whole[exponent:]}"


def _canonical(v, key: str, drop: frozenset, normal: frozenset) -> str:
    """One text for equal values. Plain recursion over Python frames."""
    if isinstance(v, _Members):
        parts = []
        for k, x in v:
            if k not in drop:
                parts.append(json.dumps(k, ensure_ascii=False) + ":" + _canonical(x, k, drop, normal))
        return "{" + ",".join(sorted(parts)) + "}"
    if isinstance(v, list):
        parts = []
        for x in v:
            parts.append(_canonical(x, key, drop, normal))
        return "[" + ",".join(sorted(parts)) + "]"
    if isinstance(v, _Number):
        return _number(v)
    if isinstance(v, str) and key in normal:
        v = WS.sub(" ", v).strip(" ")
    return json.dumps(v, ensure_ascii=False)


def _leaves(v, path: str, key: str, drop: frozenset, normal: frozenset, out: list) -> None:
    if isinstance(v, _Members):
        kept = [(k, x) for k, x in v if k not in drop]
        for k, x in kept:
            _leaves(x, path + "." + NAME.sub(r"\\\1", k), k, drop, normal, out)
        if not kept:
            out.append((path, "{}"))
    elif isinstance(v, list) and v:
        for x in v:
            out.append((path + "[]", _canonical(x, key, drop, normal)))
    else:
        out.append((path, _canonical(v, key, drop, normal)))


def _root(text: str | None, skip: frozenset, only: frozenset):
    """(parsed root with the wanted sections, None) or (None, raw text)."""
    try:
        root = _parse(text)
    except (ValueError, RecursionError, TypeError):
        return None, "<null>" if text is None else text
    if isinstance(root, _Members):
        root = _Members((k, x) for k, x in root if k not in skip and (not only or k in only))
    return root, None


def _column(doc: Column, make, schema: str, ignore_keys, ignore_sections, include_root_keys, normalize_keys) -> Column:
    drop, skip, only, normal = (frozenset(x) for x in (ignore_keys, ignore_sections, include_root_keys, normalize_keys))

    @F.pandas_udf(schema)
    def run(docs: Iterator[pd.Series]) -> Iterator[pd.Series]:
        sys.setrecursionlimit(max(sys.getrecursionlimit(), 100_000))
        for batch in docs:
            yield pd.Series([make(*_root(t if isinstance(t, str) else None, skip, only), drop, normal) for t in batch], dtype=object)
    return run(doc)


def _leaf_list(root, raw, drop, normal) -> list[dict]:
    out: list = []
    if raw is not None:
        out.append(("$", raw))
    else:
        _leaves(root, "$", "", drop, normal, out)
    return [{"path": p, "value": v} for p, v in out]


def _text(root, raw, drop, normal) -> str:
    return "?" + raw if raw is not None else "=" + _canonical(root, "", drop, normal)


def root_keys(docs: DataFrame, id_col: str, doc_col: str, include: list[str] | None = None,
              ignore: list[str] | None = None) -> DataFrame:
    """Root sections kept: the ignore list first, then the include list
    (if not empty)."""
    sections = F.try_variant_get(F.try_parse_json(doc_col), "$", "map<string,variant>")
    k = docs.select(F.col(id_col).alias("doc_id"), F.explode(F.map_keys(sections)).alias("root_key"))
    if ignore:
        k = k.where(~F.col("root_key").isin(list(ignore)))
    if include:
        k = k.where(F.col("root_key").isin(list(include)))
    return k


def leaves(docs: DataFrame, id_col: str, doc_col: str, ignore_keys=(), ignore_sections=(),
           include_root_keys=(), normalize_keys=()) -> DataFrame:
    """C15 (+S14): canonical leaves of each document, at any depth."""
    found = _column(F.col(doc_col), _leaf_list, LEAF, ignore_keys, ignore_sections, include_root_keys, normalize_keys)
    return docs.select(F.col(id_col).alias("doc_id"), F.explode(found).alias("l")).select("doc_id", "l.path", "l.value")


def leaf_diff(expected: DataFrame, actual: DataFrame, check_id: str = "C15") -> DataFrame:
    """Per document, leaves whose multiplicity differs: MISSING (more in
    expected) or UNEXPECTED (more in actual)."""
    u = expected.select("doc_id", "path", "value", F.lit(1).alias("_side")) \
        .unionByName(actual.select("doc_id", "path", "value", F.lit(-1).alias("_side")))
    g = u.groupBy("doc_id", "path", "value").agg(F.sum("_side").alias("_more")).where("_more != 0")
    miss = F.col("_more") > 0
    return g.select(F.lit(check_id).alias("check_id"), F.lit("document").alias("object_kind"),
                    F.col("doc_id").cast("string").alias("object_key"), F.col("path").alias("field"),
                    F.when(miss, F.lit("MISSING")).otherwise(F.lit("UNEXPECTED")).alias("status"),
                    F.when(miss, F.col("value")).alias("expected"),
                    F.when(~miss, F.col("value")).alias("actual")).select(*FINDINGS_COLS)


def document_diff(expected: DataFrame, actual: DataFrame, id_col: str, doc_col: str, check_id: str = "C15", **rules) -> DataFrame:
    """``leaf_diff`` of the documents whose canonical texts differ. Documents of
    equal raw texts are never parsed, documents of equal canonical texts never
    flattened. A document that differs without a differing leaf is CHANGED at
    '$', with both hashes."""
    rest = {k: rules.get(k, ()) for k in ("ignore_keys", "ignore_sections", "include_root_keys", "normalize_keys")}

    def hashed(df: DataFrame, side: int, text: Column) -> DataFrame:
        return df.select(F.col(id_col).alias("_id"), F.sha2(F.coalesce(text, F.lit("<null>")), 256).alias("_h"), F.lit(side).alias("_side"))

    def uneven(e: DataFrame, a: DataFrame, text: Column) -> DataFrame:
        both = hashed(e, 1, text).unionByName(hashed(a, -1, text))
        return both.groupBy("_id", "_h").agg(F.sum("_side").alias("_more")).where("_more != 0")

    def only(df: DataFrame, ids: DataFrame) -> DataFrame:
        return df.join(ids, F.col(id_col).eqNullSafe(F.col("_id")), "left_semi")

    raw = uneven(expected, actual, F.col(doc_col)).select("_id").distinct()
    canonical = uneven(only(expected, raw), only(actual, raw), _column(F.col(doc_col), _text, "string", **rest))
    odd = canonical.select("_id").distinct()
    found = leaf_diff(*(leaves(only(df, odd), id_col, doc_col, **rest) for df in (expected, actual)), check_id)

    sides = canonical.groupBy(F.col("_id").cast("string").alias("object_key")).agg(
        F.array_join(F.sort_array(F.collect_set(F.when(F.col("_more") > 0, F.col("_h")))), ",").alias("expected"),
        F.array_join(F.sort_array(F.collect_set(F.when(F.col("_more") < 0, F.col("_h")))), ",").alias("actual"))
    told = found.select(F.col("object_key").alias("_told")).distinct()
    untold = sides.join(told, F.col("object_key").eqNullSafe(F.col("_told")), "left_anti").select(
        F.lit(check_id).alias("check_id"), F.lit("document").alias("object_kind"), "object_key", F.lit("$").alias("field"),
        F.lit("CHANGED").alias("status"), "expected", "actual")
    return found.unionByName(untold.select(*FINDINGS_COLS))
