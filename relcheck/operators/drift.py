"""Expected-vs-actual comparison of catalog objects.

Every comparison is set-at-a-time over *all* objects of a kind (a whole
fleet of databases at once): one join per kind, never a driver loop over
tables. Results are findings (``relcheck.operators.findings``).

Policies (SURVEY §2.7):
* ``subset``   - only objects missing from actual are reported;
* ``equal``    - missing and unexpected objects are reported;
* attribute compare ``lenient`` (null = '' = 0) or ``strict`` (null-safe).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from relcheck.functions.text import glob_match, lenient
from relcheck.operators.findings import FINDINGS_COLS


def _key_text(cols: list[str]) -> Column:
    return F.concat_ws(".", *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in cols])


def _rows(status: Column | str, check_id: str, kind: str, key: Column, field=None,
          expected=None, actual=None) -> list[Column]:
    def s(v):
        if v is None:
            return F.lit(None).cast("string")
        return F.lit(v) if isinstance(v, str) else v.cast("string")
    return [F.lit(check_id).alias("check_id"), F.lit(kind).alias("object_kind"), key.alias("object_key"),
            s(field).alias("field"), s(status).alias("status"), s(expected).alias("expected"),
            s(actual).alias("actual")]


def skip_if_empty(expected: DataFrame, check_id: str, kind: str) -> DataFrame:
    """SURVEY quirk 18: an empty expected side is a SKIP finding, not a
    pass. Computed by Spark (one count), never on the driver; yields one
    row when ``expected`` is empty, else none."""
    return expected.agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") == 0).select(
        *_rows("SKIP", check_id, kind, F.lit("*"), None, F.lit("expected side is empty"), None))


def drift_set(expected: DataFrame, actual: DataFrame, key: list[str], kind: str,
              check_id: str, policy: str = "equal", skip_when_empty: bool = False) -> DataFrame:
    """Set comparison on the key columns. One ``full_outer`` join
    of the distinct keys with side flags. With ``skip_when_empty`` an empty
    expected side adds a SKIP finding."""
    e = expected.select(*key).distinct().withColumn("_e", F.lit(True))
    a = actual.select(*key).distinct().withColumn("_a", F.lit(True))
    j = e.join(a, [e[c].eqNullSafe(a[c]) for c in key], "full_outer") \
        .select(*[F.coalesce(e[c], a[c]).alias(c) for c in key], "_e", "_a")
    status = F.when(F.col("_a").isNull(), F.lit("MISSING"))
    if policy == "equal":
        status = status.when(F.col("_e").isNull(), F.lit("UNEXPECTED"))
    out = j.select(*_rows(status, check_id, kind, _key_text(key))).where(F.col("status").isNotNull())
    return out.unionByName(skip_if_empty(expected, check_id, kind)) if skip_when_empty else out


def drift_columns(expected: DataFrame, actual: DataFrame, attrs: dict[str, str],
                  mode: str = "strict", policy: str = "equal", check_id: str = "C2",
                  table_key=("table_schema", "table_name"), column="column_name",
                  report_extra_tables: bool = False) -> DataFrame:
    """Missing tables, then per existing table missing /
    unexpected columns and attribute mismatches (name -> 'string', 'number' or
    'boolean'). Tables that exist only in actual are not reported (the
    reference's default); with ``report_extra_tables`` they are, as UNEXPECTED
    tables. A column that a side lists more than once is CHANGED with field
    ``<listed>`` and both counts; its first row by value is compared.

    Plan: both sides tagged, unioned and shuffled once by table; columns are
    aggregated from that one shuffle, and a window over a table's columns tells
    which sides have it, so that nothing is read or sorted twice. Of a table that
    one side lacks its first column stands for the table."""
    tk, names = list(table_key), list(attrs)
    key = [*tk, column]

    def side(df: DataFrame, tag: str, other: str) -> DataFrame:
        row = F.struct(*[F.col(c) for c in names])
        return df.select(*key, row.alias(f"_{tag}"), F.lit(None).cast(df.select(row.alias("r")).schema["r"].dataType).alias(f"_{other}"))

    rows = side(expected, "e", "a").unionByName(side(actual, "a", "e")).repartition(*tk)
    cols = rows.groupBy(*key).agg(F.count("_e").alias("_n_e"), F.count("_a").alias("_n_a"), F.min("_e").alias("_e"), F.min("_a").alias("_a"))
    whole = Window.partitionBy(*tk)
    placed = cols.withColumns({"_in_e": F.max(F.col("_n_e") > 0).over(whole), "_in_a": F.max(F.col("_n_a") > 0).over(whole),
                               "_first": F.row_number().over(whole.orderBy(column)) == 1})

    def differs(c: str) -> Column:
        x, y = F.col(f"_e.{c}"), F.col(f"_a.{c}")
        if mode == "lenient":
            x, y = lenient(x, attrs[c]), lenient(y, attrs[c])
        return ~x.eqNullSafe(y)

    none = F.lit(None).cast("string")

    def found(field, status, exp, act) -> Column:
        return F.struct(field.alias("field"), F.lit(status).alias("status"), exp.alias("expected"), act.alias("actual"))

    both = (F.col("_n_e") > 0) & (F.col("_n_a") > 0)
    items = [F.when(F.col("_n_a") == 0, found(none, "MISSING", none, none)),
             F.when((F.col("_n_e") > 1) | (F.col("_n_a") > 1), found(F.lit("<listed>"), "CHANGED", F.col("_n_e").cast("string"), F.col("_n_a").cast("string")))]
    if policy == "equal":
        items.append(F.when(F.col("_n_e") == 0, found(none, "UNEXPECTED", none, none)))
    items += [F.when(both & differs(c), found(F.lit(c), "CHANGED", F.col(f"_e.{c}").cast("string"), F.col(f"_a.{c}").cast("string"))) for c in names]
    status = F.when(~F.col("_in_a"), F.lit("MISSING"))
    if report_extra_tables:
        status = status.when(~F.col("_in_e"), F.lit("UNEXPECTED"))
    there = F.col("_in_e") & F.col("_in_a")
    of_table = F.array(F.when(F.col("_first") & status.isNotNull(), F.struct(
        none.alias("field"), status.alias("status"), none.alias("expected"), none.alias("actual"))))
    return placed.select(F.when(there, F.lit("column")).otherwise(F.lit("table")).alias("object_kind"), F.when(there, _key_text(key)).otherwise(_key_text(tk)).alias("object_key"),
                         F.explode(F.array_compact(F.when(there, F.array(*items)).otherwise(of_table))).alias("x")).select(
        F.lit(check_id).alias("check_id"), "object_kind", "object_key", "x.*").select(*FINDINGS_COLS)


def ignore_tables(df: DataFrame, globs: list[str], schema_col="table_schema",
                  table_col="table_name") -> DataFrame:
    """Drop objects whose ``schema.table`` matches an ignore glob."""
    if not globs:
        return df
    return df.where(~glob_match(F.concat_ws(".", schema_col, table_col), globs))


def ignore_columns(df: DataFrame, per_table: dict[str, list[str]], table_col="table_name",
                   column="column_name") -> DataFrame:
    """Per-table ignored column lists (config), applied to both sides."""
    cond = F.lit(False)
    for t, cols in per_table.items():
        cond = cond | ((F.col(table_col) == t) & F.col(column).isin(cols))
    return df.where(~cond)


def ignore_privileges(df: DataFrame, grantees=(), privileges=(), grantee_col="grantee", privilege_col="privilege_type") -> DataFrame:
    """Drop grants of ignored grantees and ignored privilege kinds (config
    lists, applied to both sides)."""
    ignored = F.col(grantee_col).isin(list(grantees)) | F.col(privilege_col).isin(list(privileges))
    return df.where(~F.coalesce(ignored, F.lit(False)))


def definitions_drift(expected: DataFrame, actual: DataFrame, key: list[str], value_col: str,
                      kind: str, check_id: str) -> DataFrame:
    """MISSING and CHANGED by a normalised text or hash column; extra
    objects are ignored (left join)."""
    e = expected.select(*key, F.col(value_col).alias("_ev"))
    a = actual.select(*[F.col(c).alias(f"_a_{c}") for c in key], F.col(value_col).alias("_av"), F.lit(True).alias("_in"))
    j = e.join(a, [F.col(c).eqNullSafe(F.col(f"_a_{c}")) for c in key], "left")  # a null key part is a value
    status = F.when(F.col("_in").isNull(), F.lit("MISSING")) \
        .when(~F.col("_ev").eqNullSafe(F.col("_av")), F.lit("CHANGED"))
    return j.select(*_rows(status, check_id, kind, _key_text(key), value_col,
                           F.col("_ev"), F.col("_av"))).where(F.col("status").isNotNull())


def key_list_drift(expected: DataFrame, actual: DataFrame, table_key: list[str], list_col: str,
                   kind: str, check_id: str) -> DataFrame:
    """One ordered column list per table (names ignored): MISSING,
    UNEXPECTED, CHANGED."""
    e = expected.select(*table_key, F.col(list_col).alias("_ev"))
    a = actual.select(*table_key, F.col(list_col).alias("_av"))
    j = e.join(a, [e[c].eqNullSafe(a[c]) for c in table_key], "full_outer") \
        .select(*[F.coalesce(e[c], a[c]).alias(c) for c in table_key], "_ev", "_av")
    status = (F.when(F.col("_av").isNull(), F.lit("MISSING"))
              .when(F.col("_ev").isNull(), F.lit("UNEXPECTED"))
              .when(F.col("_ev") != F.col("_av"), F.lit("CHANGED")))
    return j.select(*_rows(status, check_id, kind, _key_text(table_key), list_col,
                           F.col("_ev"), F.col("_av"))).where(F.col("status").isNotNull())


def multiset_drift(expected: DataFrame, actual: DataFrame, group_key: list[str], kind: str,
                   check_id: str) -> DataFrame:
    """C4: multiset comparison: counts per (table, column list) on both
    sides; a differing count is MISSING (fewer in actual) or UNEXPECTED."""
    e = expected.groupBy(*group_key).agg(F.count(F.lit(1)).alias("_ne"))
    a = actual.groupBy(*group_key).agg(F.count(F.lit(1)).alias("_na"))
    j = e.join(a, [e[c].eqNullSafe(a[c]) for c in group_key], "full_outer") \
        .select(*[F.coalesce(e[c], a[c]).alias(c) for c in group_key],
                F.coalesce("_ne", F.lit(0)).alias("_ne"), F.coalesce("_na", F.lit(0)).alias("_na"))
    status = F.when(F.col("_ne") > F.col("_na"), F.lit("MISSING")) \
        .when(F.col("_ne") < F.col("_na"), F.lit("UNEXPECTED"))
    return j.select(*_rows(status, check_id, kind, _key_text(group_key), "count",
                           F.col("_ne"), F.col("_na"))).where(F.col("status").isNotNull())
