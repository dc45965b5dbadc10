"""Flat XML datasets of several tables (A1, A2): an element a row, its name the
table, an attribute a column, a null an attribute left out.

No column is given: one pass over all elements gathers every table's attribute
names (column sensing, so that a first row without a column hides nothing); then
one read parses each element once and deals it to its table. Files are cut at
'>', so their size and line breaks do not matter, and a '>' inside a quoted value
is none.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from relcheck.sources.files import new_scratch
from relcheck.sources.records import read_lines, records

ROOT = "dataset"
TAG = r"^\s*<([^\s/>!?][^\s/>]*)"
ATTRIBUTE = r"""\s([^\s=<>"'/]+)\s*=\s*(?:"[^"]*"|'[^']*')"""


def element(table: str, df: DataFrame) -> DataFrame:
    """(value): a row as an element; all values as text."""
    cols = [F.col(f"`{c}`").cast("string").alias("_" + c) for c in df.columns]
    return df.select(F.to_xml(F.struct(*cols), {"rowTag": table, "attributePrefix": "_"}).alias("value"))


def write_dataset(tables: dict[str, DataFrame], path: str) -> None:
    """A2: all tables into one dataset."""
    out = None
    for table, df in tables.items():
        rows = element(table, df)
        out = rows if out is None else out.unionByName(rows)
    out.write.text(path)


def elements(spark: SparkSession, path: str, root: str = ROOT, pattern: str | None = None) -> DataFrame:
    """(file_path, record_no, tag, xml): every element but the root, written
    once."""
    pieces = read_lines(spark, path, pattern, end=">")
    quotes = F.length("line") - F.length(F.replace("line", F.lit('"'), F.lit("")))
    found = records(pieces, quotes, lambda n: n % 2 == 0, end=">")
    tag = F.regexp_extract("record", TAG, 1)
    xml = F.concat(F.regexp_replace("record", r"^\s+|\s*/?\s*$", ""), F.lit("/>"))
    kept = found.select("file_path", "record_no", tag.alias("tag"), xml.alias("xml")).where((F.col("tag") != "") & (F.col("tag") != root))
    staged = new_scratch(spark, "elements")
    kept.write.parquet(staged)
    return spark.read.schema(kept.schema).parquet(staged)


def sensed_columns(found: DataFrame) -> DataFrame:
    """(tag, column, at): every attribute name of a table, with the place of the
    first element that has it."""
    names = F.regexp_extract_all("xml", F.lit(ATTRIBUTE), F.lit(1))
    each = found.select("tag", F.posexplode(names).alias("i", "column"), F.struct("file_path", "record_no").alias("place"))
    return each.groupBy("tag", "column").agg(F.min(F.struct("place", "i")).alias("at"))


def read_dataset(spark: SparkSession, path: str, root: str = ROOT, pattern: str | None = None) -> dict[str, DataFrame]:
    """A1: {table: rows} of all tables in the files, all values text, columns in
    the order they are first seen. To the driver come tables' column names."""
    found = elements(spark, path, root, pattern)
    columns: dict[str, list[str]] = {}
    rows_only = found.select("tag").distinct().collect()
    for r in sensed_columns(found).orderBy("tag", "at").collect():
        columns.setdefault(r.tag, []).append(r["column"])
    return {r.tag: _parsed(found.where(F.col("tag") == r.tag), columns.get(r.tag, [])) for r in rows_only}


def _parsed(rows: DataFrame, columns: list[str]) -> DataFrame:
    if not columns:
        return rows.select()
    schema = ", ".join(f"`_{c}` string" for c in columns)
    row: Column = F.from_xml("xml", schema, {"attributePrefix": "_", "nullValue": "\x00", "ignoreSurroundingSpaces": "false"})
    return rows.select(row.alias("r")).select(*[F.col(f"r.`_{c}`").alias(c) for c in columns])
