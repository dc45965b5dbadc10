"""Column profiles that are kept and merged.

A table's new days are profiled in one pass over them, all columns at once; of
every (table, column, day) one row is kept: counts, the longest text, least and
greatest value and a HyperLogLog sketch of the values. The profile of any span of
days is a merge of kept rows: old days are never read again. Estimates of distinct
values are within about 2.5 / sqrt(2**LG_K) of the truth (``observed_profile`` in
``constraints`` counts exactly).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

LG_K = 12
BY = ["table_name", "column_name"]


def _value(field: T.StructField) -> Column:
    """A value as (number, real, text), one of them not null: kept rows of
    columns of any types are one table, and still order as the values do."""
    c, kind = F.col(f"`{field.name}`"), field.dataType
    number, real, text = F.lit(None).cast("decimal(38,10)"), F.lit(None).cast("double"), F.lit(None).cast("string")
    if isinstance(kind, (T.IntegralType, T.DecimalType)):
        number = c.cast("decimal(38,10)")
    elif isinstance(kind, T.FractionalType):
        real = c.cast("double")
    else:
        text = c.cast("string")
    return F.when(c.isNotNull(), F.struct(number.alias("number"), real.alias("real"), text.alias("text")))


def day_profiles(df: DataFrame, table: str, day: Column, lg_k: int = LG_K) -> DataFrame:
    """(table_name, column_name, day, n_rows, n_nulls, max_length, low, high,
    sketch): one aggregation over ``df``, a row a column and day."""
    aggs, fields = [F.count(F.lit(1)).alias("n_rows")], df.schema.fields
    for i, f in enumerate(fields):
        c = F.col(f"`{f.name}`")
        plain = c if isinstance(f.dataType, (T.IntegerType, T.LongType, T.StringType, T.BinaryType)) else c.cast("string")
        length = F.max(F.length(c)) if isinstance(f.dataType, T.StringType) else F.lit(None).cast("int")
        aggs += [F.count_if(c.isNull()).alias(f"n{i}"), length.alias(f"l{i}"), F.min(_value(f)).alias(f"a{i}"), F.max(_value(f)).alias(f"z{i}"),
                 F.hll_sketch_agg(plain, lg_k).alias(f"s{i}")]
    by_day = df.groupBy(day.alias("day")).agg(*aggs)
    rows = F.array(*[F.struct(F.lit(f.name).alias("column_name"), F.col(f"n{i}").alias("n_nulls"), F.col(f"l{i}").alias("max_length"),
                              F.col(f"a{i}").alias("low"), F.col(f"z{i}").alias("high"), F.col(f"s{i}").alias("sketch")) for i, f in enumerate(fields)])
    return by_day.select(F.lit(table).alias("table_name"), "day", "n_rows", F.explode(rows).alias("c")) \
        .select("table_name", "c.column_name", "day", "n_rows", "c.n_nulls", "c.max_length", "c.low", "c.high", "c.sketch")


def refreshed(kept: DataFrame, new: DataFrame) -> DataFrame:
    """Kept rows with days profiled anew in place of their old rows."""
    days = new.select(F.col("table_name").alias("_t"), F.col("day").alias("_d")).distinct()
    same = (F.col("table_name") == F.col("_t")) & F.col("day").eqNullSafe(F.col("_d"))
    return kept.join(days, same, "left_anti").unionByName(new)


def merged_profile(kept: DataFrame) -> DataFrame:
    """(table_name, column_name, n_rows, n_nulls, n_distinct, max_length,
    min_number, min_text, max_number, max_text) of all kept rows together."""
    g = kept.groupBy(*BY).agg(F.sum("n_rows").alias("n_rows"), F.sum("n_nulls").alias("n_nulls"), F.max("max_length").alias("max_length"),
                              F.min("low").alias("low"), F.max("high").alias("high"), F.hll_union_agg("sketch").alias("sketch"))

    def number(side: str) -> Column:
        return F.coalesce(F.col(f"{side}.number").cast("double"), F.col(f"{side}.real"))

    return g.select(*BY, "n_rows", "n_nulls", F.hll_sketch_estimate("sketch").alias("n_distinct"), "max_length",
                    number("low").alias("min_number"), F.col("low.text").alias("min_text"), number("high").alias("max_number"), F.col("high.text").alias("max_text"))
