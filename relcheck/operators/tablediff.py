"""Table data comparison, expected vs actual (C11, C14, C17).

Keyed diff plan: both sides are tagged, unioned and grouped once by the key.
Grouping treats null key parts as equal, so a null key needs no special join.
Only (key, side, 128-bit row fingerprint) is shuffled; the fingerprint hashes a
null flag and the value of every column, so a null never lines up with a
neighbouring value. The rows of differing keys alone are fetched (one more tagged
union) and compared cell by cell. Keyless (multiset) diff: both sides unioned
with a side flag and counted per full row in one aggregation. Columns that only
one side has are findings of their own.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from relcheck.operators.findings import FINDINGS_COLS

FINDING_STRUCT = "array<struct<object_kind:string,object_key:string,field:string,status:string,expected:string,actual:string>>"


def _key_text(cols: list[str], prefix: str = "") -> Column:
    return F.concat_ws("|", *[F.coalesce(F.col(prefix + c).cast("string"), F.lit("<null>")) for c in cols])


def _compared(expected: DataFrame, actual: DataFrame, key: list[str], ignore: list[str] | None) -> list[str]:
    """The columns both sides have, besides the key and the ignored ones."""
    skip = set(key) | set(ignore or [])
    return [c for c in expected.columns if c in actual.columns and c not in skip]


def column_set(expected: DataFrame, actual: DataFrame, key: list[str] | None = None,
               ignore_cols: list[str] | None = None, check_id: str = "C11") -> DataFrame:
    """Findings for columns that one side lacks: MISSING (only in expected) and
    UNEXPECTED (only in actual). No row is read."""
    skip = set(ignore_cols or [])
    only = [(c, "MISSING") for c in expected.columns if c not in actual.columns and c not in skip]
    only += [(c, "UNEXPECTED") for c in actual.columns if c not in expected.columns and c not in skip]
    none = F.lit(None).cast("string")
    rows = F.array(*[F.struct(F.lit("column").alias("object_kind"), F.lit(c).alias("object_key"), none.alias("field"),
                              F.lit(s).alias("status"), none.alias("expected"), none.alias("actual")) for c, s in only])
    one = expected.sparkSession.range(1)
    return one.select(F.lit(check_id).alias("check_id"), F.inline(rows.cast(FINDING_STRUCT))).select(*FINDINGS_COLS)


# A 64-bit row hash is summed per key as three parts of 22 bits: each sum stays
# exact (no overflow) up to 2^41 rows per key, and the sums are plain longs,
# so the per-key aggregation stays in fast fixed-width hash aggregation.
_PARTS = [(22 * i, (1 << 22) - 1) for i in range(3)]


def _tagged(expected: DataFrame, actual: DataFrame, make) -> DataFrame:
    """Both sides as one frame; ``_side`` is 1 for expected, -1 for actual."""
    return make(expected).withColumn("_side", F.lit(1)).unionByName(make(actual).withColumn("_side", F.lit(-1)))


def _key_states(expected: DataFrame, actual: DataFrame, key: list[str], cols: list[str]) -> DataFrame:
    """Per key: row counts of both sides and ``_s``: MISSING, UNEXPECTED,
    DIFFER (one row each, not equal), ROWS (repeated key, rows not equal) or
    null (equal). One shuffle of (key, fingerprint), combined map-side."""
    e_type, a_type = ({f.name: f.dataType for f in df.schema} for df in (expected, actual))
    value = {c: F.col(c) if e_type[c] == a_type[c] else F.col(c).cast("string") for c in cols}  # as in _cells
    marked = [x for c in cols for x in (F.col(c).isNull(), value[c])] or [F.lit(0)]

    def make(df: DataFrame) -> DataFrame:
        return df.select(*key, F.xxhash64(*marked).alias("_h1"), F.xxhash64(F.lit("relcheck"), *marked).alias("_h2"))

    parts = {f"{h}_{at}": F.sum(F.col("_side") * F.shiftrightunsigned(F.col(h), at).bitwiseAND(F.lit(mask)))
             for h in ("_h1", "_h2") for at, mask in _PARTS}
    g = _tagged(expected, actual, make).groupBy(*key).agg(
        F.count_if(F.col("_side") == 1).alias("_n_e"), F.count_if(F.col("_side") == -1).alias("_n_a"),
        *[v.alias(k) for k, v in parts.items()])
    differs = reduce(lambda x, y: x | y, [F.col(k) != 0 for k in parts], F.col("_n_e") != F.col("_n_a"))
    state = (F.when(F.col("_n_a") == 0, F.lit("MISSING")).when(F.col("_n_e") == 0, F.lit("UNEXPECTED"))
             .when(differs & (F.col("_n_e") == 1) & (F.col("_n_a") == 1), F.lit("DIFFER")).when(differs, F.lit("ROWS")))
    return g.select(*key, "_n_e", "_n_a", state.alias("_s"))


def _cells(states: DataFrame, expected: DataFrame, actual: DataFrame, key: list[str], cols: list[str]) -> DataFrame:
    """key + (field, expected, actual): every cell that differs, of the keys in
    state DIFFER. One tagged union of both sides, reduced to those keys."""
    differ = states.where(F.col("_s") == "DIFFER").select(*[F.col(c).alias(f"_k_{c}") for c in key])

    def make(df: DataFrame) -> DataFrame:
        same = reduce(lambda x, y: x & y, [F.col(c).eqNullSafe(F.col(f"_k_{c}")) for c in key])
        return df.join(differ, same, "left_semi").select(*key, F.struct(*cols).alias("_r"))

    both = (make(expected).withColumnRenamed("_r", "_e").unionByName(make(actual).withColumnRenamed("_r", "_a"), allowMissingColumns=True)
            .groupBy(*key).agg(F.first("_e", True).alias("_e"), F.first("_a", True).alias("_a")))
    e_type, a_type = ({f.name: f.dataType for f in df.schema} for df in (expected, actual))

    def value(side: str, c: str) -> Column:  # columns of one name and two types are compared as text
        return F.col(f"_{side}.{c}") if e_type[c] == a_type[c] else F.col(f"_{side}.{c}").cast("string")

    changed = [F.when(~value("e", c).eqNullSafe(value("a", c)),
                      F.struct(F.lit(c).alias("field"), value("e", c).cast("string").alias("expected"), value("a", c).cast("string").alias("actual")))
               for c in cols]
    return both.select(*key, F.explode(F.array_compact(F.array(*changed))).alias("_c")).select(*key, "_c.*")


def diff_keyed(expected: DataFrame, actual: DataFrame, key: list[str],
               ignore_cols: list[str] | None = None, check_id: str = "C11",
               object_kind: str = "row") -> DataFrame:
    """Findings: MISSING (key only in expected), UNEXPECTED (only in actual),
    CHANGED (one row per differing cell, null-safe), and columns that one side
    lacks. Null key parts equal each other. A key that repeats on a side and
    differs is CHANGED with field ``<rows>`` and both row counts, and each of
    its rows that one side has more of is ``<row>`` with its JSON text (no row
    pairs are formed).
    """
    cols = _compared(expected, actual, key, ignore_cols)
    states = _key_states(expected, actual, key, cols)
    base = [F.lit(check_id).alias("check_id"), F.lit(object_kind).alias("object_kind"), _key_text(key).alias("object_key")]
    none = F.lit(None).cast("string")
    is_rows = F.col("_s") == "ROWS"
    whole = states.where(F.col("_s").isin("MISSING", "UNEXPECTED", "ROWS")).select(
        *base, F.when(is_rows, F.lit("<rows>")).otherwise(none).alias("field"),
        F.when(is_rows, F.lit("CHANGED")).otherwise(F.col("_s")).alias("status"),
        F.when(is_rows, F.col("_n_e").cast("string")).otherwise(none).alias("expected"),
        F.when(is_rows, F.col("_n_a").cast("string")).otherwise(none).alias("actual"))
    out = whole
    if cols:
        changed = _cells(states, expected, actual, key, cols).select(*base, "field", F.lit("CHANGED").alias("status"), "expected", "actual")
        out = out.unionByName(changed).unionByName(_repeated(states, expected, actual, key, cols, base))
    return out.unionByName(column_set(expected, actual, key, ignore_cols, check_id)).select(*FINDINGS_COLS)


def _repeated(states: DataFrame, expected: DataFrame, actual: DataFrame, key: list[str], cols: list[str], base: list[Column]) -> DataFrame:
    """The rows of repeated keys that one side has more often, as JSON text."""
    keys = states.where(F.col("_s") == "ROWS").select(*[F.col(c).alias(f"_k_{c}") for c in key])
    same = reduce(lambda x, y: x & y, [F.col(c).eqNullSafe(F.col(f"_k_{c}")) for c in key])

    def make(df: DataFrame) -> DataFrame:
        return df.join(keys, same, "left_semi").select(*key, F.to_json(F.struct(*cols), {"ignoreNullFields": "false"}).alias("_row"))

    g = _tagged(expected, actual, make).groupBy(*key, "_row").agg(F.sum("_side").alias("_more")).where("_more != 0")
    more = F.col("_more") > 0
    return g.select(*base, F.lit("<row>").alias("field"), F.lit("CHANGED").alias("status"),
                    F.when(more, F.col("_row")).alias("expected"), F.when(~more, F.col("_row")).alias("actual"))


def diff_multiset(expected: DataFrame, actual: DataFrame,
                  ignore_cols: list[str] | None = None) -> DataFrame:
    """Keyless comparison (= ``exceptAll`` both ways, with multiplicity):
    the full rows whose count differs, with both counts and a status. Both
    sides must have the same columns; ``column_set`` tells which do not fit."""
    skip = set(ignore_cols or [])
    cols = [c for c in expected.columns if c not in skip]
    odd = sorted(set(cols) ^ {c for c in actual.columns if c not in skip})
    if odd:
        raise ValueError(f"columns of one side only: {', '.join(odd)} (see column_set, or ignore them)")
    u = _tagged(expected, actual, lambda df: df.select(*cols))
    g = u.groupBy(*cols).agg(F.count_if(F.col("_side") == 1).alias("n_expected"), F.count_if(F.col("_side") == -1).alias("n_actual"))
    return g.where(F.col("n_expected") != F.col("n_actual")).withColumn(
        "status", F.when(F.col("n_expected") > F.col("n_actual"), F.lit("MISSING")).otherwise(F.lit("UNEXPECTED")))


def diff_counts(expected: DataFrame, actual: DataFrame, key: list[str],
                ignore_cols: list[str] | None = None) -> DataFrame:
    """Row counts and outcome counts of the keyed diff as (metric, value).
    Rows and keys are counted from the key states, cells from the cells."""
    cols = _compared(expected, actual, key, ignore_cols)
    states = _key_states(expected, actual, key, cols)
    n = states.agg(F.coalesce(F.sum("_n_e"), F.lit(0)).alias("rows_expected"), F.coalesce(F.sum("_n_a"), F.lit(0)).alias("rows_actual"),
                   F.count_if(F.col("_s") == "MISSING").alias("missing_rows"), F.count_if(F.col("_s") == "UNEXPECTED").alias("unexpected_rows"),
                   F.count_if(F.col("_s").isin("DIFFER", "ROWS")).alias("changed_rows"), F.count_if(F.col("_s") == "ROWS").alias("_repeated"))
    names = ["rows_expected", "rows_actual", "missing_rows", "unexpected_rows", "changed_rows"]
    long = n.select(F.inline(F.array(*[F.struct(F.lit(x).alias("metric"), F.col(x).alias("value")) for x in names])))
    # a repeated key counts as one changed cell (its rows are not paired)
    cells = n.select(F.col("_repeated").alias("n"))
    if cols:
        cells = cells.unionByName(_cells(states, expected, actual, key, cols).agg(F.count("*").alias("n")))
    return long.unionByName(cells.agg(F.sum("n").alias("value")).select(F.lit("changed_cells").alias("metric"), "value"))


def rollback_check(before: DataFrame, forward: DataFrame, after_rollback: DataFrame,
                   expected_forward: DataFrame, key: list[str], table: str) -> DataFrame:
    """C17: state after rollback must equal the state before; forward state
    must equal the expected one. Findings of both comparisons, tagged."""
    a = diff_keyed(before, after_rollback, key, check_id="C17.rollback", object_kind=table)
    b = diff_keyed(expected_forward, forward, key, check_id="C17.forward", object_kind=table)
    return a.unionByName(b)


def table_fingerprints(df: DataFrame, group_cols: list[str], order_col: str,
                       value_cols: list[str]) -> DataFrame:
    """Per table, SHA-256 of its ordered rows (order significant),
    one text line per row. Rows per group are catalog rows (bounded by the
    column limit of a table), so ordering them in the group is safe."""
    # nulls are written out and values quoted, so no two rows share a text
    line = F.to_json(F.struct(*[F.col(c).cast("string").alias(c) for c in value_cols]), {"ignoreNullFields": "false"})
    # collecting does not shrink data: shuffle rows on the group key first
    return df.select(*group_cols, F.col(order_col), line.alias("_l")).repartition(*group_cols) \
        .groupBy(*group_cols).agg(
        F.sha2(F.array_join(F.transform(
            F.array_sort(F.collect_list(F.struct(F.col(order_col).alias("o"), F.col("_l").alias("l")))),
            lambda x: x["l"]), ","), 256).alias("fingerprint"))


def fingerprint_diff(expected: DataFrame, actual: DataFrame, key: list[str],
                     check_id: str = "C14", object_kind: str = "table") -> DataFrame:
    e = expected.select(*key, F.col("fingerprint").alias("_e"), F.lit(None).cast("string").alias("_a"))
    a = actual.select(*key, F.lit(None).cast("string").alias("_e"), F.col("fingerprint").alias("_a"))
    j = e.unionByName(a).groupBy(*key).agg(F.max("_e").alias("_e"), F.max("_a").alias("_a"))
    status = (F.when(F.col("_a").isNull(), F.lit("MISSING"))
              .when(F.col("_e").isNull(), F.lit("UNEXPECTED"))
              .when(F.col("_e") != F.col("_a"), F.lit("CHANGED")))
    return j.select(F.lit(check_id).alias("check_id"), F.lit(object_kind).alias("object_kind"),
                    F.concat_ws(".", *key).alias("object_key"), F.lit("fingerprint").alias("field"),
                    status.alias("status"), F.col("_e").alias("expected"), F.col("_a").alias("actual")) \
        .where(F.col("status").isNotNull())
