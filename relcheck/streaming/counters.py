"""Counters of running streams (E19): what ``observe()`` reports of every
micro-batch, gathered by a listener.

A batch's numbers are kept under (query, batch, name), in memory and as one small
file each below ``path``, so a batch that is replayed, also by a later run from
the same checkpoint, replaces its own numbers and counts once (a sink that has the batch already does
not run it again and reports zeros, which change nothing). The query's id lives
in its checkpoint.
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQueryListener

FILE_SCHEMA = "query string, batch long, name string, counts map<string,long>"


class CounterListener(StreamingQueryListener):
    """``spark.streams.addListener(CounterListener(spark, path))``."""

    def __init__(self, spark: SparkSession, path: str | None = None):
        self.spark, self.path, self.seen = spark, path, {}

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        p = event.progress
        for name, row in p.observedMetrics.items():
            counts = {k: int(v) for k, v in row.asDict().items()}
            if not any(counts.values()):  # nothing came, or a sink that has the batch already left it out
                continue
            self.seen[str(p.id), p.batchId, name] = counts
            if self.path:
                self._write(f"{p.id}-{p.batchId}-{name}.json", {"query": str(p.id), "batch": p.batchId, "name": name, "counts": counts})

    def totals(self) -> dict[str, int]:
        """Sums over all batches this listener has seen."""
        out: dict[str, int] = {}
        for counts in self.seen.values():
            for k, n in counts.items():
                out[k] = out.get(k, 0) + n
        return out

    def _write(self, name: str, value: dict) -> None:
        """One small file, written over, in whatever store the path is in."""
        sc = self.spark.sparkContext
        where = sc._jvm.org.apache.hadoop.fs.Path(self.path, name)
        out = where.getFileSystem(sc._jsc.hadoopConfiguration()).create(where, True)
        try:
            out.write(bytearray(json.dumps(value).encode()))
        finally:
            out.close()


def counter_table(spark: SparkSession, path: str) -> DataFrame:
    """(metric, value) over all batches of all runs that wrote to ``path``."""
    rows = spark.read.schema(FILE_SCHEMA).json(path).select(F.explode("counts").alias("metric", "n"))
    return rows.groupBy("metric").agg(F.sum("n").alias("value"))
