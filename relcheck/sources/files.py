"""File sources and sinks (A1-A8): flat XML datasets, JSON snapshots, CSV
message files and limited exports. All are Spark's own readers/writers
with explicit schemas (no inference pass over the data)."""

from __future__ import annotations

import atexit
import contextlib
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from relcheck.session import scratch_path


def new_scratch(spark: SparkSession, kind: str) -> str:
    """A fresh folder under the session's checkpoint folder (shared storage
    on a cluster); never a machine-local temp dir. Removed when the application
    ends."""
    path = scratch_path(spark, f"{kind}-{uuid.uuid4().hex}")
    atexit.register(_remove, spark, path)
    return path


def _remove(spark: SparkSession, path: str) -> None:
    with contextlib.suppress(Exception):  # the JVM may be gone by now
        sc = spark.sparkContext
        where = sc._jvm.org.apache.hadoop.fs.Path(path)
        where.getFileSystem(sc._jsc.hadoopConfiguration()).delete(where, True)


# ------------------------------------------------------------ flat XML
def write_flat_xml(df: DataFrame, path: str, schema_name: str, table_name: str) -> None:
    """A2: one ``<schema.table col="..."/>`` element per row, every value as
    text, a null value is an attribute left out, '' is kept."""
    cols = [F.col(c).cast("string").alias("_" + c) for c in df.columns]
    (df.select(*cols).write.format("xml")
       .option("rootTag", "dataset").option("rowTag", f"{schema_name}.{table_name}")
       .option("attributePrefix", "_").mode("overwrite").save(path))


def read_flat_xml(spark: SparkSession, path: str, schema_name: str, table_name: str,
                  columns: list[str]) -> DataFrame:
    """A1: element -> row, attribute -> column; a missing attribute is null.
    The column list is given (no schema inference), all values text."""
    schema = T.StructType([T.StructField("_" + c, T.StringType()) for c in columns])
    df = (spark.read.format("xml").option("rowTag", f"{schema_name}.{table_name}")
          .option("attributePrefix", "_").schema(schema).load(path))
    return df.select(*[F.col("_" + c).alias(c) for c in columns])


# ------------------------------------------------------------ JSON snapshots
def write_snapshots(df: DataFrame, path: str) -> None:
    """A4: one JSON document per table (one line each), nested columns kept."""
    df.write.mode("overwrite").json(path)


def read_snapshots(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """A3: snapshot documents read with the known schema (absent key -> null)."""
    return spark.read.schema(schema).json(path)


# ------------------------------------------------------------ CSV messages
def write_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("header", True).csv(path)


def read_csv_strings(spark: SparkSession, path: str, columns: list[str]) -> DataFrame:
    """A5: header CSV with an explicit all-string schema: every record stays
    as text, so blank and bad values reach validation instead of failing
    the read."""
    schema = T.StructType([T.StructField(c, T.StringType()) for c in columns])
    return spark.read.option("header", True).schema(schema).csv(path)


# ------------------------------------------------------------ exports
def export_limited(df: DataFrame, columns: list[str], order_by: list[str], row_limit: int | None) -> DataFrame:
    """Explicit column list, optional row limit. A key order makes the
    limited export deterministic (plans as TakeOrderedAndProject)."""
    out = df.select(*columns)
    if row_limit is not None:
        out = out.orderBy(*order_by).limit(row_limit)
    return out
