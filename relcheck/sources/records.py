"""Records of text files that span lines, numbered in file order.

A file is read as lines, by all tasks at once, however large it is. A line knows
its file, its input split's first byte and its place among the lines its task has
read; both orders are the file's. What a record is follows from sums: a CSV
record begins at a line with an even number of quotes before it, a JSON record
where as many brackets were closed as opened. So every split is summed once, the
sums of the splits before are added, and a window inside the split (never more
than one task has read) does the rest. No file is ever a single row or task.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from relcheck.sources.files import new_scratch

FILE, SPLIT = "file_path", "split"
#: A JSON string, which holds no line break; brackets inside it are none.
JSON_STRING = r'"(?:[^"\\]|\\.)*"'


def read_lines(spark: SparkSession, path: str, pattern: str | None = None, end: str = "\n") -> DataFrame:
    """(file_path, split, place, line), written once so that places stay. Only
    ``end`` ends a line."""
    reader = spark.read.option("lineSep", end)
    if pattern:
        reader = reader.option("pathGlobFilter", pattern)
    lines = reader.text(path).select(F.col("_metadata.file_path").alias(FILE), F.col("_metadata.file_block_start").alias(SPLIT),
                                     F.monotonically_increasing_id().alias("place"), F.col("value").alias("line"))
    staged = new_scratch(spark, "lines")
    lines.write.parquet(staged)
    return spark.read.schema(lines.schema).parquet(staged)


def before_split(sums: DataFrame, value: str) -> DataFrame:
    """The sum of ``value`` over a file's earlier splits; a row a split."""
    earlier = Window.partitionBy(FILE).orderBy(SPLIT).rowsBetween(Window.unboundedPreceding, -1)
    return sums.select(F.col(FILE).alias("_file"), F.col(SPLIT).alias("_split"), F.coalesce(F.sum(value).over(earlier), F.lit(0)).alias("_before"))


def running(lines: DataFrame, value: Column, out: str) -> DataFrame:
    """``out``: the sum of ``value`` over all lines of the file before this one."""
    sums = before_split(lines.groupBy(FILE, SPLIT).agg(F.sum(value).alias("_v")), "_v")
    inside = Window.partitionBy(FILE, SPLIT).orderBy("place").rowsBetween(Window.unboundedPreceding, -1)
    j = lines.withColumn("_inside", F.coalesce(F.sum(value).over(inside), F.lit(0)))
    on = (F.col(FILE) == F.col("_file")) & (F.col(SPLIT) == F.col("_split"))
    return j.join(sums, on).select(*lines.columns, (F.col("_inside") + F.col("_before")).alias(out))


def records(lines: DataFrame, value: Column, begins: Callable[[Column], Column], end: str = "\n") -> DataFrame:
    """(file_path, record_no, record): lines gathered into records, numbered from
    0 in file order. ``begins``: whether a record begins at a line, by the sum of
    ``value`` before it. Blank lines between records are none."""
    state = running(lines, value, "_state")
    starts = begins(F.col("_state")) & (F.trim(F.regexp_replace("line", "\r$", "")) != "")
    blank = begins(F.col("_state")) & ~starts
    told = running(state.where(~blank).select(*lines.columns, starts.cast("long").alias("_starts")), F.col("_starts"), "_n")
    numbered = told.withColumn("record_no", F.col("_n") + F.col("_starts") - 1)
    gathered = numbered.groupBy(FILE, "record_no").agg(F.array_sort(F.collect_list(F.struct(SPLIT, "place", "line"))).alias("lines"))
    text = F.array_join(F.transform("lines", lambda x: x["line"]), end)
    return gathered.where("record_no >= 0").select(FILE, "record_no", F.regexp_replace(text, "\r$", "").alias("record"))


def read_csv_records(spark: SparkSession, path: str, columns: list[str], header: bool = True, pattern: str | None = None) -> DataFrame:
    """(file_path, row_no from 1, record, columns as text) of CSV files with
    quotes doubled inside quotes; fields may hold line breaks. With ``header``
    the first record of each file is left out."""
    lines = read_lines(spark, path, pattern)
    quotes = F.length("line") - F.length(F.replace("line", F.lit('"'), F.lit("")))
    found = records(lines, quotes, lambda n: n % 2 == 0)
    if header:
        found = found.where("record_no > 0")
    row = F.from_csv("record", ", ".join(f"`{c}` string" for c in columns), {"escape": '"', "multiLine": "true", "lineSep": "\x01"})
    number = F.col("record_no") + (0 if header else 1)
    return found.select(FILE, number.alias("row_no"), "record", row.alias("r")).select(FILE, "row_no", "record", "r.*")


def read_json_records(spark: SparkSession, path: str, pattern: str | None = None) -> DataFrame:
    """(file_path, row_no from 1, payload): the JSON documents of files as they
    are written, one after another, each over any number of lines."""
    lines = read_lines(spark, path, pattern)
    bare = F.regexp_replace("line", JSON_STRING, "")
    depth = F.length(F.regexp_replace(bare, r"[^\[{]", "")) - F.length(F.regexp_replace(bare, r"[^\]}]", ""))
    found = records(lines, depth, lambda n: n == 0)
    return found.select(FILE, (F.col("record_no") + 1).alias("row_no"), F.col("record").alias("payload"))

