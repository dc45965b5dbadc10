"""Connected components of an edge table, as Spark joins.

Alternating large-star and small-star steps: every node points to ever smaller
neighbours until the edges are stars about the smallest node. Each step is one
aggregation and one join on the node; the edges are staged in the shared folder
between steps, so the plan stays short and lost executors cost one step. Only
two sums come to the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from relcheck.llm.shared import staged


def star(edges: DataFrame, large: bool) -> DataFrame:
    """One step over (a, b) with a > b. ``large``: link a node's larger
    neighbours to its smallest one (or itself), else its smaller ones."""
    both = edges if not large else edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("of"), F.least("of", "m").alias("m"))
    linked = both.join(least, F.col("a") == F.col("of"))
    if large:
        return linked.where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a > b").distinct()
    smaller = linked.select(F.col("b").alias("a"), F.col("m").alias("b")).where("a > b")
    return smaller.unionByName(least.select(F.col("of").alias("a"), F.col("m").alias("b")).where("a > b")).distinct()


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, component): the smallest node reachable, for every node that has
    an edge to another. Ids are longs or binary; null ends and loops are ignored."""
    now = edges.select(F.greatest(a, b).alias("a"), F.least(a, b).alias("b")).where("a > b").distinct()
    before, step = None, 0
    while True:
        now = staged(now, f"edges{step}")
        mark = now.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if mark == before or not mark[0]:
            break
        before, step = mark, step + 1
        now = star(star(now, large=True), large=False)
    return now.select(F.col("a").alias("node"), F.col("b").alias("component")) \
              .unionByName(now.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct())
