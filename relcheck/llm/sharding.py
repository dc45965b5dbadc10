"""Operator 7 [native]: shards of equal bytes by histogram sort.

Method: every document has a sort key; exact bytes and rows below candidate
key boundaries are counted across all partitions at once, probes are refined
only inside the cells that hold a splitter, until every splitter is exact to
the row; then rows are exchanged once, by cell of the key, and numbered.

The key is 60 bits of md5 over (id, text): a fixed, reproducible shuffle, so
copies and sources spread evenly and no key is hot. A boundary has 12 more bits
in each round, so a splitter of 10**10 documents is exact after three rounds.
Slots come from exact counts: rows below the cell plus the rank in the cell;
cells are sized to a few thousand rows, so no shard is ever in one task.

Defined results: null text has size 8 and CRC 0; rows with equal id and text
are interchangeable, lie in one shard and get distinct slots; an empty table
gives an empty result; the caller's columns travel in one struct, so none can
clash.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from relcheck.llm.shared import row_of, staged

BITS, STEP = 60, 12
#: Rows of a numbering cell, about.
CELL_ROWS = 4096
#: Equal rows of less than this part of a shard's bytes stay in one shard.
FINE = 256


def sort_key(*parts: Column) -> Column:
    """The first 60 bits of md5 over the parts, as a whole number. Null and
    empty differ, and so do parts cut at other places."""
    packed = F.concat_ws(":", *[F.coalesce(F.concat(F.length(p.cast("string")).cast("string"), F.lit("."), p.cast("string")), F.lit("null")) for p in parts])
    return F.conv(F.substring(F.md5(packed.cast("binary")), 1, 15), 16, 10).cast("long")


def size_of(text: str = "text") -> Column:
    return F.coalesce(F.octet_length(F.col(f"`{text}`")), F.lit(0)).cast("long") + 8


def histogram(rows: DataFrame, bits: int, inside: list[int] | None) -> list:
    """Bytes and rows of every cell of 2**(BITS-bits) keys; ``inside``: only
    cells whose parent of the round before is listed. 4096 a parent at most."""
    cell = F.shiftright("k", BITS - bits)
    if inside is not None:
        rows = rows.where(F.shiftright("k", BITS - bits + STEP).isin(inside))
    return rows.groupBy(cell.alias("cell")).agg(F.sum("size").alias("bytes"), F.count("*").alias("n"),
                                                F.min("k").alias("low"), F.max("k").alias("high")).orderBy("cell").collect()


def many_equal(n, size, total: int, shards: int):
    """Whether n rows of one key, ``size`` bytes in all, are told apart; of
    numbers or columns."""
    return (n > 1) & ((n > CELL_ROWS) | (size * (shards * FINE) > total))


def splitters(rows: DataFrame, shards: int) -> tuple[list[tuple[int, int, int]], int, int]:
    """For each of the inner boundaries i: (key, rank, rows below it), the least
    with at least i/shards of all bytes below it; below are smaller keys, and of
    the key itself the rows of a smaller rank. Rows below the first boundary
    belong to shard 0, and so on. Also the row count and all bytes."""
    first = histogram(rows, STEP, None)
    total = sum(c.bytes for c in first)
    want = [-(-total * i // shards) for i in range(1, shards)]
    # of each splitter not found yet: bytes and rows below its cell, and that cell
    at, found, bits = {i: (0, 0) for i in range(len(want))}, {}, STEP
    cells: dict[int | None, list] = {None: first}
    parent: dict[int, int | None] = dict.fromkeys(at)
    while at:
        inside = set()
        for i in list(at):
            below, n = at[i]
            nxt = None
            for c in cells[parent[i]]:
                if below + c.bytes >= want[i]:
                    nxt = c
                    break
                below, n = below + c.bytes, n + c.n
            if nxt is None:  # only in an empty table
                found[i] = (1 << BITS, 0, n)
            elif (nxt.low == nxt.high or bits >= BITS) and not many_equal(nxt.n, nxt.bytes, total, shards):
                found[i] = (nxt.high + 1, 0, n + nxt.n)  # one key left: the boundary lies behind it
            elif nxt.low == nxt.high or bits >= BITS:  # as many of its rows as are needed, all of one size
                rank = max(1, min(nxt.n, -(-(want[i] - below) * nxt.n // nxt.bytes)))
                found[i] = (nxt.high, rank, n + rank)
            else:
                at[i], parent[i] = (below, n), nxt.cell
                inside.add(nxt.cell)
                continue
            del at[i]
        if at:
            bits += STEP
            cells = {p: [] for p in inside}
            for c in histogram(rows, bits, sorted(inside)):
                cells[c.cell >> STEP].append(c)
    return [found[i] for i in range(len(want))], sum(c.n for c in first), total


def pick(bounds: list[tuple[int, int]], key: Column, rank: Column, values: list[int], low: int = 0) -> Column:
    """values[number of bounds that are <= (key, rank)], as a balanced tree."""
    if not bounds:
        return F.lit(values[low])
    mid = len(bounds) // 2
    at, first = F.lit(bounds[mid][0]).cast("long"), F.lit(bounds[mid][1]).cast("long")
    return F.when((key < at) | ((key == at) & (rank < first)), pick(bounds[:mid], key, rank, values, low)) \
            .otherwise(pick(bounds[mid + 1:], key, rank, values, low + mid + 1))


def numbered(rows: DataFrame, again: DataFrame) -> DataFrame:
    """The rows whose key is in ``again``, with ``r``: 0, 1, ... among the rows of
    one key. They are written, so that their place stays; of each key and input
    split one window numbers what one task has read at most."""
    many = rows.join(again, "k", "left_semi").select(*rows.columns, F.spark_partition_id().alias("split"), F.monotonically_increasing_id().alias("place"))
    many = staged(many, "equal")
    counts = many.groupBy("k", "split").agg(F.count("*").alias("n"))
    before = counts.select(F.col("k").alias("of_k"), F.col("split").alias("of_split"), (F.sum("n").over(Window.partitionBy("k").orderBy("split")) - F.col("n")).alias("before"))
    own = many.withColumn("own", F.row_number().over(Window.partitionBy("k", "split").orderBy("place")))
    told = own.join(staged(before, "before"), (F.col("k") == F.col("of_k")) & (F.col("split") == F.col("of_split")))
    return told.select(*rows.columns, (F.col("before") + F.col("own") - 1).alias("r"))


def shard_by_bytes(docs: DataFrame, shards: int = 24, text: str = "text", key: str = "doc_id",
                   carry: list[str] | None = None) -> DataFrame:
    """(row, size, k, shard int, slot long): ``row`` has the caller's columns,
    or those named in ``carry``. The histograms read a staged table of keys and
    sizes; the rows themselves are exchanged once, by cell of the key."""
    rows = docs.select(row_of(docs, carry), size_of(text).alias("size"),
                       sort_key(F.col(f"`{key}`"), F.col(f"`{text}`")).alias("k"))
    keys = staged(rows.select("k", "size"), "keys")
    cuts, total, size = splitters(keys, shards)
    groups = keys.groupBy("k").agg(F.count("*").alias("n"), F.sum("size").alias("bytes"))
    again = staged(groups.where(many_equal(F.col("n"), F.col("bytes"), size, shards)).select("k"), "again")
    equal = numbered(rows, again)
    bits = min(BITS, (total // CELL_ROWS).bit_length())
    shard = pick([c[:2] for c in cuts], F.col("k"), F.col("r"), list(range(shards))).cast("int")

    def placed(of: DataFrame, names: list[str]) -> DataFrame:
        both = of.join(again, "k", "left_anti").select(*names, F.lit(0).cast("long").alias("r")).unionByName(equal.select(*names, "r"))
        return both.select("*", shard.alias("shard"), F.shiftright("k", BITS - bits).alias("cell"), F.floor(F.col("r") / CELL_ROWS).alias("chunk"))

    # rows before each cell of a shard: one row a cell, so small and never hot
    before = (placed(keys, ["k"]).groupBy(F.col("shard").alias("of_shard"), F.col("cell").alias("of_cell"), F.col("chunk").alias("of_chunk")).agg(F.count("*").alias("n"))
              .withColumn("before", F.sum("n").over(Window.partitionBy("of_shard").orderBy("of_cell", "of_chunk")) - F.col("n")))
    ranked = placed(rows, rows.columns).withColumn("rank", F.row_number().over(Window.partitionBy("shard", "cell", "chunk").orderBy("k", "r")))
    return (ranked.join(before, (F.col("shard") == F.col("of_shard")) & (F.col("cell") == F.col("of_cell")) & (F.col("chunk") == F.col("of_chunk")))
            .select("row", "size", "k", "shard", (F.col("before") + F.col("rank") - 1).alias("slot")))
