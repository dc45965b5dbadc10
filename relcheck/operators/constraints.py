"""Declared constraints checked against the data rows (D1-D7). Spark does
not enforce them, so these checks are how a release proves them.
All return findings (``relcheck.operators.findings``)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from relcheck.operators.findings import FINDINGS_COLS


def _long_to_findings(long: DataFrame, check_id: str, kind: str, expected: str,
                      fail_when) -> DataFrame:
    return long.select(
        F.lit(check_id).alias("check_id"), F.lit(kind).alias("object_kind"),
        F.col("object_key"), F.col("field"),
        F.when(fail_when, F.lit("VIOLATION")).otherwise(F.lit("PASS")).alias("status"),
        F.lit(expected).alias("expected"), F.col("n").cast("string").alias("actual")).select(*FINDINGS_COLS)


def _unpivot_counts(agg: DataFrame, names: list[tuple[str, str, str]]) -> DataFrame:
    """One-row aggregate -> (object_key, field, n) rows."""
    return agg.select(F.explode(F.array(*[
        F.struct(F.lit(k).alias("object_key"), F.lit(f).alias("field"), F.col(c).alias("n"))
        for c, k, f in names])).alias("x")).select("x.*")


def check_not_null(df: DataFrame, table: str, cols: list[str] | None = None) -> DataFrame:
    """Null count per NOT NULL column, all columns in one pass."""
    cols = cols or df.columns
    agg = df.agg(*[F.count_if(F.col(c).isNull()).alias(f"_n{i}") for i, c in enumerate(cols)])
    long = _unpivot_counts(agg, [(f"_n{i}", f"{table}.{c}", "null_count") for i, c in enumerate(cols)])
    return _long_to_findings(long, "D1", "column", "0", F.col("n") > 0)


def _exact(df: DataFrame, column: str) -> Column:
    """The column in a type that compares as written: decimals as they are,
    whole numbers as decimals (so that the least long has an absolute value)."""
    kind = df.schema[column].dataType
    if isinstance(kind, T.DecimalType):
        return F.col(column)
    return F.col(column).cast("decimal(20,0)" if isinstance(kind, T.IntegralType) else "double")


def _at_least(c: Column, power: int) -> Column:
    """|c| >= 10 ** power, by decimals; no decimal type reaches 10 ** 38."""
    if power >= 38:
        return F.abs(c.cast("double")) >= F.lit(10.0 ** power)
    text = "1" + "0" * power if power >= 0 else "0." + "0" * (-power - 1) + "1"
    return F.abs(c) >= F.lit(text).cast(f"decimal({max(power, 0) + 1 + max(-power, 0)},{max(-power, 0)})")


def check_length_precision(df: DataFrame, table: str, rules: list[dict]) -> DataFrame:
    """Values too long for ``char_max``, or with more integer digits than
    ``num_precision - num_scale`` allows, or more decimals than
    ``num_scale``. One pass for all rules."""
    exprs, names = [], []
    for i, r in enumerate(rules):
        if r.get("char_max") is not None:
            exprs.append(F.count_if(F.length(r["column"]) > r["char_max"]).alias(f"_r{i}"))
            names.append((f"_r{i}", f"{table}.{r['column']}", f"char_max={r['char_max']}"))
        if r.get("num_precision") is not None:
            p, s, c = r["num_precision"], r.get("num_scale") or 0, _exact(df, r["column"])
            exprs.append(F.count_if(_at_least(c, p - s)).alias(f"_p{i}"))
            names.append((f"_p{i}", f"{table}.{r['column']}", f"num_precision={p},num_scale={s}"))
            exprs.append(F.count_if(c != F.round(c, s)).alias(f"_s{i}"))
            names.append((f"_s{i}", f"{table}.{r['column']}", f"num_scale={s}"))
    long = _unpivot_counts(df.agg(*exprs), names)
    return _long_to_findings(long, "D2", "column", "0", F.col("n") > 0)


def _key_text(cols: list[str]):
    return F.concat_ws("|", *[F.coalesce(F.col(c).cast("string"), F.lit("<null>")) for c in cols])


def duplicate_keys(df: DataFrame, key: list[str], skip_null_keys: bool) -> DataFrame:
    """Keys with more than one row (partial count before the shuffle)."""
    src = df.select(*key)
    if skip_null_keys:
        src = src.dropna(subset=key)
    return src.groupBy(*key).agg(F.count(F.lit(1)).alias("n_rows")).where("n_rows > 1")


def check_pk(df: DataFrame, table: str, key: list[str]) -> DataFrame:
    """D3: primary key: rows with a null key part, and duplicate keys."""
    nulls = df.agg(F.count_if(F.greatest(*[F.col(c).isNull() for c in key])
                              if len(key) > 1 else F.col(key[0]).isNull()).alias("n")) \
        .select(F.lit("D3").alias("check_id"), F.lit("table").alias("object_kind"),
                F.lit(table).alias("object_key"), F.lit("null_key_rows").alias("field"),
                F.when(F.col("n") > 0, F.lit("VIOLATION")).otherwise(F.lit("PASS")).alias("status"),
                F.lit("0").alias("expected"), F.col("n").cast("string").alias("actual"))
    dups = duplicate_keys(df, key, skip_null_keys=True).select(
        F.lit("D3").alias("check_id"), F.lit("key").alias("object_kind"),
        F.concat(F.lit(table + ":"), _key_text(key)).alias("object_key"), F.lit("duplicate_rows").alias("field"),
        F.lit("VIOLATION").alias("status"), F.lit("1").alias("expected"),
        F.col("n_rows").cast("string").alias("actual"))
    return nulls.unionByName(dups)


def check_unique(df: DataFrame, table: str, cols: list[str]) -> DataFrame:
    """UNIQUE: duplicates among rows whose key parts are all non-null."""
    return duplicate_keys(df, cols, skip_null_keys=True).select(
        F.lit("D4").alias("check_id"), F.lit("key").alias("object_kind"),
        F.concat(F.lit(table + ":"), _key_text(cols)).alias("object_key"), F.lit("duplicate_rows").alias("field"),
        F.lit("VIOLATION").alias("status"), F.lit("1").alias("expected"),
        F.col("n_rows").cast("string").alias("actual"))


def check_fk(child: DataFrame, parent: DataFrame, child_cols: list[str], parent_cols: list[str],
             name: str) -> DataFrame:
    """Child rows whose (non-null) key has no parent, one finding per
    orphan key value with its row count. Child keys are counted first
    (partial aggregation), so the anti join sees each key once."""
    keys = child.select(*child_cols).dropna().groupBy(*child_cols).agg(F.count(F.lit(1)).alias("n_rows"))
    p = parent.select(*[F.col(pc).alias(cc) for pc, cc in zip(parent_cols, child_cols)]).distinct()
    orphans = keys.join(p, child_cols, "left_anti")
    return orphans.select(
        F.lit("D5").alias("check_id"), F.lit("foreign_key").alias("object_kind"),
        F.concat(F.lit(name + ":"), _key_text(child_cols)).alias("object_key"), F.lit("orphan_rows").alias("field"),
        F.lit("VIOLATION").alias("status"), F.lit("0").alias("expected"),
        F.col("n_rows").cast("string").alias("actual"))


def _column_profile(df: DataFrame, table: str, field: T.StructField) -> DataFrame:
    """One column's profile from its values and how often each comes."""
    c, v = F.col(field.name), F.col("_v")
    real = isinstance(field.dataType, (T.FloatType, T.DoubleType))  # 0.0 and -0.0 are one value of two texts
    g = df.groupBy(c.alias("_v")).agg(F.count(F.lit(1)).alias("_n"), *([F.min(c).alias("_lo"), F.max(c).alias("_hi")] if real else []))
    none = F.lit(0).cast("long")
    return g.agg(
        F.lit(table).alias("table_name"), F.lit(field.name).alias("column_name"), F.coalesce(F.sum("_n"), none).alias("n_rows"),
        F.coalesce(F.sum(F.when(v.isNull(), F.col("_n"))), none).alias("n_nulls"), F.count(v).alias("n_distinct"),
        (F.max(F.length(v)) if isinstance(field.dataType, T.StringType) else F.lit(None).cast("int")).alias("max_length"),
        F.min("_lo" if real else "_v").cast("string").alias("min_value"), F.max("_hi" if real else "_v").cast("string").alias("max_value"))


def observed_profile(df: DataFrame, table: str, approx_distinct: bool = False) -> DataFrame:
    """Per column: rows, nulls, distinct, max text length, min, max, a row a
    column. Exact counts take one aggregation a column, over that column alone: a
    task holds values of one column, not of all of them. Approximate ones take one
    aggregation in all."""
    fields = df.schema.fields
    if not approx_distinct and fields:
        return reduce(DataFrame.unionByName, [_column_profile(df, table, f) for f in fields])
    aggs = [F.count(F.lit(1)).alias("_rows")]
    for i, f in enumerate(fields):
        c = F.col(f.name)
        aggs += [F.count_if(c.isNull()).alias(f"_null{i}"), F.approx_count_distinct(c).alias(f"_dist{i}"),
                 (F.max(F.length(c)) if isinstance(f.dataType, T.StringType)
                  else F.lit(None).cast("int")).alias(f"_len{i}"),
                 F.min(c).cast("string").alias(f"_min{i}"), F.max(c).cast("string").alias(f"_max{i}")]
    a = df.agg(*aggs)
    return a.select(F.explode(F.array(*[F.struct(
        F.lit(table).alias("table_name"), F.lit(f.name).alias("column_name"),
        F.col("_rows").alias("n_rows"), F.col(f"_null{i}").alias("n_nulls"),
        F.col(f"_dist{i}").alias("n_distinct"), F.col(f"_len{i}").alias("max_length"),
        F.col(f"_min{i}").alias("min_value"), F.col(f"_max{i}").alias("max_value"))
        for i, f in enumerate(fields)])).alias("p")).select("p.*")


def check_sequence_headroom(sequences: DataFrame, owners: DataFrame, data: DataFrame,
                            data_schema: str, data_table: str) -> DataFrame:
    """For each sequence owned by a column of ``data``, the largest value
    used vs the declared maximum. The column maxima come from one
    aggregation over the data (unpivoted), then joined to the (catalog
    sized) ownership rows."""
    num_cols = [f.name for f in data.schema.fields
                if isinstance(f.dataType, (T.IntegerType, T.LongType, T.ShortType, T.DecimalType))]
    maxima = data.agg(*[F.max(c).cast("decimal(38,0)").alias(c) for c in num_cols])
    used = maxima.select(F.explode(F.array(*[
        F.struct(F.lit(c).alias("column_name"), F.col(c).alias("max_used")) for c in num_cols])).alias("m")) \
        .select("m.*")
    own = owners.where((F.col("table_schema") == data_schema) & (F.col("table_name") == data_table))
    j = own.join(sequences, ["sequence_schema", "sequence_name"], "inner").join(used, "column_name", "inner")
    declared = F.col("maximum_value").cast("decimal(38,0)")
    return j.select(
        F.lit("D7").alias("check_id"), F.lit("sequence").alias("object_kind"),
        F.concat_ws(".", "sequence_schema", "sequence_name").alias("object_key"),
        F.concat_ws(".", "table_name", "column_name").alias("field"),
        F.when(F.col("max_used") > declared, F.lit("VIOLATION")).otherwise(F.lit("PASS")).alias("status"),
        F.col("maximum_value").alias("expected"), F.col("max_used").cast("string").alias("actual"))
