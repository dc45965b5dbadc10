"""All tables of a release compared in one job (C11, C17).

The rows of all tables, of both sides and of all comparisons are one long frame
(comparison, table, bucket of the key's hash, fingerprint), and a digest tree is
walked from its root: tables, then the buckets of the tables that differ, then
the keys (by hash) of the buckets that differ, then their rows. A digest is a sum of row fingerprints, made
map-side, so an equal pair moves one row a task, however large it is, and of an
unequal one only fingerprints and typed rows of differing buckets move, and texts
are made of rows of differing keys alone. To the driver comes the first
level only, a row a table; tables found equal there are not read again.

Tables may have any columns and types: what is compared are the columns that both
sides have; columns of one name and two types are compared as text. A table
without a key is compared as a multiset of rows.
"""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass
from functools import reduce
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql import types as T

from relcheck.operators import tablediff as td
from relcheck.operators.findings import FINDINGS_COLS

#: Buckets a table: of a changed row, 1 / BUCKETS of its table moves.
BUCKETS = 4096
SANDBOX = "sandbox"
NAME = ["comparison", "table_name"]


@dataclass
class TablePair:
    """One table of one comparison. Without ``key``: a multiset of rows."""
    table: str
    expected: DataFrame
    actual: DataFrame
    key: tuple[str, ...] = ()
    ignore: tuple[str, ...] = ()
    comparison: str = "data"


@dataclass
class ReleaseTable:
    """A table's versions: before the release, after it, as expected after it,
    and after the rollback (none: not rolled back)."""
    table: str
    before: DataFrame
    forward: DataFrame
    expected_forward: DataFrame
    after_rollback: DataFrame | None = None
    key: tuple[str, ...] = ()
    ignore: tuple[str, ...] = ()


class Comparison(NamedTuple):
    #: (comparison, table_name, rows_expected, rows_actual, missing, unexpected, changed, columns, verdict)
    verdicts: DataFrame
    #: comparison and the columns of any findings; object_kind is the table
    findings: DataFrame


def _columns(pair: TablePair) -> tuple[list[str], dict[str, Column], dict[str, Column], Column]:
    """The compared columns, their values (texts where the sides' types differ),
    their texts, and the key's hash, equal where the key's text is. Texts take long
    to make: a value that has one text of its own is hashed as it is."""
    e, a = ({f.name: f.dataType for f in x.schema} for x in (pair.expected, pair.actual))
    cols = [c for c in e if c in a and c not in pair.ignore]
    text = {c: F.col(f"`{c}`").cast("string") for c in cols}
    value = {c: F.col(f"`{c}`") if e[c] == a[c] else text[c] for c in cols}

    def mark(c: str) -> list[Column]:
        if e[c] != a[c]:
            return [text[c].isNull(), text[c]]
        if isinstance(e[c], (T.FloatType, T.DoubleType)):  # 0.0 and -0.0 are one value of two texts
            return [value[c].isNull(), value[c], F.when(value[c] == 0, text[c])]
        plain = isinstance(e[c], (T.IntegralType, T.BooleanType, T.DateType, T.TimestampNTZType, T.DecimalType)) or e[c] == T.StringType()
        return [value[c].isNull(), value[c] if plain else text[c]]

    marks = [x for c in (list(pair.key) or cols) for x in mark(c)]
    return cols, value, text, F.xxhash64(*marks)


def _side(pair: TablePair, df: DataFrame, side: int, buckets: int) -> DataFrame:
    cols, value, _, hashed = _columns(pair)
    marked = [x for c in cols for x in (value[c].isNull(), value[c])] or [F.lit(0)]
    return df.select(F.lit(pair.comparison).alias("comparison"), F.lit(pair.table).alias("table_name"), F.lit(side).alias("side"),
                     hashed.alias("key_hash"), F.pmod(hashed, F.lit(buckets)).cast("int").alias("bucket"),
                     F.xxhash64(*marked).alias("h1"), F.xxhash64(F.lit("relcheck"), *marked).alias("h2"))


def long_rows(pairs: Iterable[TablePair], buckets: int = BUCKETS) -> DataFrame:
    """Fingerprints of both sides of all pairs."""
    frames = [_side(p, df, side, buckets) for p in pairs for df, side in ((p.expected, 1), (p.actual, -1))]
    return reduce(lambda x, y: x.unionByName(y), frames)


def _cells(pair: TablePair, buckets: int) -> DataFrame:
    """The pair's rows of differing keys, with the key's text and the other columns
    as (field, value). No text is made of other rows."""
    cols, value, _, hashed = _columns(pair)
    row = F.struct(*[value[c].alias(c) for c in cols]) if cols else F.struct(F.lit(0).alias("_"))
    sides = [df.select(F.lit(side).alias("side"), hashed.alias("key_hash"), F.pmod(hashed, F.lit(buckets)).cast("int").alias("bucket"), row.alias("row"))
             for df, side in ((pair.expected, 1), (pair.actual, -1))]
    rows = sides[0].union(sides[1]).join(_buckets(pair, buckets), "bucket", "left_semi").join(differing_keys(pair, buckets), "key_hash", "left_semi")
    text = {c: F.col("row").getField(c).cast("string") for c in cols}
    own = [c for c in cols if c not in pair.key] if pair.key else []
    none = F.array().cast("array<struct<field:string,value:string>>")
    return rows.select(F.lit(pair.comparison).alias("comparison"), F.lit(pair.table).alias("table_name"), "side",
                       F.lit(bool(pair.key)).alias("keyed"), F.to_json(F.array(*[text[c] for c in (list(pair.key) or cols)])).alias("key"),
                       (F.array(*[F.struct(F.lit(c).alias("field"), text[c].alias("value")) for c in own]) if own else none).alias("cells"))


def digests(rows: DataFrame, by: list[str]) -> DataFrame:
    """``by``, rows of both sides, and ``differs``. Sums of 22-bit parts of two
    hashes stay exact longs up to 2**41 rows a group."""
    parts = {f"{h}_{at}": F.sum(F.col("side") * F.shiftrightunsigned(F.col(h), at).bitwiseAND(F.lit((1 << 22) - 1))) for h in ("h1", "h2") for at in (0, 22, 44)}
    g = rows.groupBy(*by).agg(F.count_if(F.col("side") == 1).alias("rows_expected"), F.count_if(F.col("side") == -1).alias("rows_actual"),
                              *[v.alias(k) for k, v in parts.items()])
    differs = reduce(lambda x, y: x | y, [F.col(k) != 0 for k in parts], F.col("rows_expected") != F.col("rows_actual"))
    return g.select(*by, "rows_expected", "rows_actual", differs.alias("differs"))


def table_digests(pairs: list[TablePair]) -> dict[tuple[str, str], Row]:
    """The first level: (rows_expected, rows_actual, differs) of each table."""
    return {(r.comparison, r.table_name): r for r in digests(long_rows(pairs), NAME).collect()}


def differing_buckets(pairs: list[TablePair], buckets: int = BUCKETS) -> DataFrame:
    """(comparison, table_name, bucket): the second level."""
    return digests(long_rows(pairs, buckets), [*NAME, "bucket"]).where("differs").select(*NAME, "bucket")


def _buckets(pair: TablePair, buckets: int) -> DataFrame:
    """A pair's differing buckets, ``buckets`` numbers at most."""
    return F.broadcast(differing_buckets([pair], buckets).select("bucket"))


def differing_keys(pair: TablePair, buckets: int = BUCKETS) -> DataFrame:
    """(key_hash) of the pair: the third level, of the rows of differing buckets."""
    rows = long_rows([pair], buckets).join(_buckets(pair, buckets), "bucket", "left_semi")
    return digests(rows, ["key_hash"]).where("differs").select("key_hash")


def _key_label(key: Column) -> Column:
    return F.array_join(F.from_json(key, "array<string>"), "|", "<null>")


def row_findings(pairs: list[TablePair], buckets: int = BUCKETS) -> DataFrame:
    """(comparison, key, findings): the last level. Keys of one side are MISSING or
    UNEXPECTED, cells that differ CHANGED; a repeated key whose rows differ is
    CHANGED in ``<rows>`` with both counts. Rows without a key that one side has
    more often are MISSING or UNEXPECTED in ``<count>`` with both counts."""
    rows = reduce(lambda x, y: x.unionByName(y), [_cells(p, buckets) for p in pairs])
    # equal rows first, so that a key with very many rows is few by then
    each = rows.groupBy(*NAME, "keyed", "key", "cells").agg(F.count_if(F.col("side") == 1).alias("e"), F.count_if(F.col("side") == -1).alias("a"))
    g = each.groupBy(*NAME, "keyed", "key").agg(
        F.sum("e").alias("e"), F.sum("a").alias("a"), F.max((F.col("e") != F.col("a"))).alias("differs"),
        F.max(F.when(F.col("e") > 0, F.col("cells"))).alias("of_e"), F.max(F.when(F.col("a") > 0, F.col("cells"))).alias("of_a")).where("differs")
    one = F.col("keyed") & (F.col("e") == 1) & (F.col("a") == 1)
    none = F.lit(None).cast("string")

    def found(field, status, e, a) -> Column:
        return F.struct(field.alias("field"), status.alias("status"), e.alias("expected"), a.alias("actual"))

    cells = F.filter(F.zip_with("of_e", "of_a", lambda x, y: F.when(~x["value"].eqNullSafe(y["value"]), found(x["field"], F.lit("CHANGED"), x["value"], y["value"]))), lambda x: x.isNotNull())
    side = F.when(F.col("a") == 0, F.lit("MISSING")).when(F.col("e") == 0, F.lit("UNEXPECTED"))
    more = F.when(F.col("e") > F.col("a"), F.lit("MISSING")).otherwise(F.lit("UNEXPECTED"))
    counts = [F.col("e").cast("string"), F.col("a").cast("string")]
    items = F.when(one, cells).when(~F.col("keyed"), F.array(found(F.lit("<count>"), more, *counts))) \
        .when(side.isNotNull(), F.array(found(none, side, none, none))).otherwise(F.array(found(F.lit("<rows>"), F.lit("CHANGED"), *counts)))
    return g.select("comparison", "key", F.lit("C11").alias("check_id"), F.col("table_name").alias("object_kind"), _key_label(F.col("key")).alias("object_key"),
                    F.explode(items).alias("f")).select("comparison", "key", "check_id", "object_kind", "object_key", "f.*").select("comparison", "key", *FINDINGS_COLS)


def compare_tables(pairs: list[TablePair], buckets: int = BUCKETS) -> Comparison:
    """Verdicts (PASS, FAIL) and findings of any number of tables. The first
    level runs at once."""
    spark, known = pairs[0].expected.sparkSession, table_digests(pairs)
    totals = [(p.comparison, p.table, *(known.get((p.comparison, p.table)) or (None, None, 0, 0, False))[2:]) for p in pairs]
    differ = [p for p, t in zip(pairs, totals, strict=True) if t[-1]]
    frames = [row_findings(differ, buckets)] if differ else []
    for p in pairs:
        if p.expected.columns != p.actual.columns:  # the schemas, no rows
            frames.append(td.column_set(p.expected, p.actual, ignore_cols=list(p.ignore)).withColumns(
                {"comparison": F.lit(p.comparison), "key": F.lit(None).cast("string"), "object_kind": F.lit(p.table), "field": F.lit("<column>")}))
    none = spark.createDataFrame([], ", ".join(f"{c} string" for c in ("comparison", "key", *FINDINGS_COLS)))
    found = reduce(lambda x, y: x.unionByName(y), [f.select("comparison", "key", *FINDINGS_COLS) for f in frames] or [none])
    column, state = F.col("key").isNull(), F.col("status")  # a key's text is never null
    keys = found.groupBy("comparison", F.col("object_kind").alias("table_name"), "status", "key").agg(F.count("*").alias("n"))
    counted = keys.groupBy(*NAME).agg(*[F.count_if((state == c.upper()) & ~column).alias(c) for c in ("missing", "unexpected", "changed")],
                                      F.sum(F.when(column, F.col("n")).otherwise(0)).alias("columns"))
    names = spark.createDataFrame(totals, "comparison string, table_name string, rows_expected long, rows_actual long, differs boolean")
    j = names.join(counted, NAME, "left")
    n = [F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in ("missing", "unexpected", "changed", "columns")]
    bad = F.col("differs") | (F.coalesce("columns", F.lit(0)) > 0)
    verdicts = j.select(*NAME, "rows_expected", "rows_actual", *n, F.when(bad, F.lit("FAIL")).otherwise(F.lit("PASS")).alias("verdict"))
    return Comparison(verdicts, found.drop("key"))


def release_check(tables: list[ReleaseTable], environment: str, buckets: int = BUCKETS) -> Comparison:
    """C17: the forward state of every table equals the expected one, and in the
    sandbox the state after the rollback equals the one before. Elsewhere, and
    for tables without a rollback, the rollback's verdict is SKIP."""
    pairs, skipped = [], []
    for t in tables:
        pairs.append(TablePair(t.table, t.expected_forward, t.forward, t.key, t.ignore, "forward"))
        if environment == SANDBOX and t.after_rollback is not None:
            pairs.append(TablePair(t.table, t.before, t.after_rollback, t.key, t.ignore, "rollback"))
        else:
            skipped.append((t.table,))
    made = compare_tables(pairs, buckets)
    if not skipped:
        return made
    zero = [F.lit(0).cast("long").alias(c) for c in ("rows_expected", "rows_actual", "missing", "unexpected", "changed", "columns")]
    skip = tables[0].before.sparkSession.createDataFrame(skipped, "table_name string").select(F.lit("rollback").alias("comparison"), "table_name", *zero, F.lit("SKIP").alias("verdict"))
    return Comparison(made.verdicts.unionByName(skip), made.findings)
