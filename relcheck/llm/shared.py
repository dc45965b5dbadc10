"""Pieces that several operators of this subpackage share: staged tables in
the cluster's shared folder, Arrow passes that carry a caller's own columns
along untouched, and 64-bit word and shingle hashing."""

from __future__ import annotations

import atexit
import contextlib
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from relcheck.session import scratch_path

#: Words of the corpus contracts: runs without space, tab, line feed, vertical
#: tab, form feed and carriage return. bytes.split() cuts at exactly these.
WORD = r"[^\x20\x09-\x0D]+"
#: A worker's cache of words is emptied when it holds so many entries, and
#: longer words are not kept, so its memory does not grow with the input.
CACHE_WORDS, CACHE_BYTES = 200_000, 64
#: Texts of an Arrow batch are worked on in slices of about this many bytes.
SLICE_BYTES = 4 << 20


def drop_folder(spark: SparkSession, path: str) -> None:
    """Remove a scratch folder through Hadoop's file system (any store)."""
    jvm = spark.sparkContext._jvm
    where = jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)


def staged(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet below ``spark.checkpoint.dir`` and read it back:
    cuts the lineage, survives lost executors, and gives the planner real
    sizes. Removed when the application ends."""
    spark = df.sparkSession
    path = scratch_path(spark, f"relcheck-{uuid.uuid4().hex}/{name}")
    df.write.parquet(path)
    atexit.register(_forget, spark, path)
    return spark.read.schema(df.schema).parquet(path)


def _forget(spark: SparkSession, path: str) -> None:
    with contextlib.suppress(Exception):  # the JVM may be gone by now
        drop_folder(spark, path.rsplit("/", 1)[0])


def row_of(docs: DataFrame, carry: list[str] | None = None) -> Column:
    """The caller's columns (or those in ``carry``) as one struct ``row``, so
    that none can clash with an operator's own."""
    return F.struct(*[F.col(f"`{c}`") for c in (docs.columns if carry is None else carry)]).alias("row")


def whole(docs: DataFrame, text: str = "text", carry: list[str] | None = None, **more: Column) -> DataFrame:
    """(row, body, ...): ``row_of`` and the text as UTF-8 bytes (null: empty)."""
    return docs.select(row_of(docs, carry),
                       F.coalesce(F.col(f"`{text}`"), F.lit("")).cast("binary").alias("body"),
                       *[c.alias(k) for k, c in more.items()])


def by_slices(batch: pa.RecordBatch, column: str = "body") -> Iterator[tuple[pa.RecordBatch, list[bytes]]]:
    """Cut an Arrow batch into runs of rows of about SLICE_BYTES of text; a
    longer text is a slice of its own."""
    sizes = pc.binary_length(batch.column(column)).to_pylist()
    start, held = 0, 0
    for i, n in enumerate(sizes):
        if i > start and held + n > SLICE_BYTES:
            part = batch.slice(start, i - start)
            yield part, part.column(column).to_pylist()
            start, held = i, 0
        held += n
    if start < len(batch):
        part = batch.slice(start)
        yield part, part.column(column).to_pylist()


def arrow_pass(df: DataFrame, fields: str, work: Callable[[], Callable[[list[bytes], pa.RecordBatch], list]],
               keep: list[str], column: str = "body") -> DataFrame:
    """Run ``work()(texts, rows)`` over slices of every partition. It returns a
    list of columns in the order of the DDL string ``fields``, one value a row.
    ``keep``: columns handed through. ``work`` itself is called once a task."""
    extra = T._parse_datatype_string(fields)
    schema = T.StructType([df.schema[c] for c in keep] + extra.fields)
    names, kinds = schema.names, [to_arrow_type(f.dataType) for f in extra.fields]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        do = work()
        for batch in batches:
            for part, texts in by_slices(batch, column):
                made = do(texts, part)
                cols = [part.column(c) for c in keep] + [pa.array(v, t) for v, t in zip(made, kinds, strict=True)]
                yield pa.RecordBatch.from_arrays(cols, names=names)

    return df.mapInArrow(run, schema)


class WordHashes(dict):
    """bytes -> 64-bit hash, filled on first sight, bounded."""

    def __missing__(self, word: bytes) -> int:
        h = xxhash.xxh64_intdigest(word)
        if len(word) <= CACHE_BYTES:
            if len(self) >= CACHE_WORDS:
                self.clear()
            self[word] = h
        return h

    def of(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), np.uint64, len(words))


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijection of 64 bits that spreads every input bit (in place)."""
    x ^= x >> np.uint64(32)
    x *= np.uint64(0xD6E8FEB86659FD93)
    x ^= x >> np.uint64(32)
    x *= np.uint64(0xD6E8FEB86659FD93)
    x ^= x >> np.uint64(32)
    return x


def shingle_hashes(words: np.ndarray, n: int) -> np.ndarray:
    """Hash of every run of n words; a shorter, not empty sequence is one run."""
    n = min(n, len(words))
    if n == 0:
        return np.zeros(0, np.uint64)
    m = len(words) - n + 1
    h = np.full(m, n, np.uint64)
    for i in range(n):
        h = mix64((h + words[i:i + m]) * np.uint64(0x9E3779B97F4A7C15))
    return h
