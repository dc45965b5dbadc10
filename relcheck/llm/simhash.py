"""Operator 13: SimHash near-duplicates by pivot distance tables.

Method: a text's fingerprint has a bit where over half of its shingles' hashes
have it. For every distinct fingerprint the Hamming distances to many reference
fingerprints are computed once; two fingerprints whose distances to any
reference differ by more than two are discarded unseen, the survivors are
compared, and linked ones form components.

Which pairs meet at all is also read off distances. The 64 bits are cut into
blocks, and each block has references of its own, which only see that block. Two
fingerprints at most two bits apart agree in all blocks but two, so they share
the cell named by the distances to all other blocks' references. With 3 blocks
that is 3 cells a fingerprint. A cell of more than FULL fingerprints is not
paired: its members go on to a table of 9 blocks (36 cells each, 7 or 8 bits
left open in two blocks), and what is crowded there to one of 22 blocks of 2 or
3 bits (231 cells), where no cell can hold more than 2**6. So no pair is lost,
and no group of copies, however large, forms all its pairs: a fingerprint meets
at most FULL others in a cell.

Copies cost nothing: only distinct fingerprints go on. A cell reports its links
as a star about the least fingerprint of each group.

Defined results: null, empty and blank texts have fingerprint zero and are
linked like any other; a row without id has a fingerprint, and links others,
but never names a component (a component of such rows alone has a null one);
rows that repeat an id each have their own text's fingerprint; an empty table
gives an empty result; the caller's columns are not touched.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from relcheck.llm.components import components
from relcheck.llm.pivots import cells, distances, fingerprint, near_pairs, references
from relcheck.llm.shared import arrow_pass, staged, whole

WORDS, MOST = 3, 2
#: Blocks of each table. The last one's cells hold 2**6 fingerprints at most.
PARTS = (3, 9, 22)
FULL = 64


def fingerprints(docs: DataFrame, text: str = "text", key: str = "doc_id", words: int = WORDS) -> DataFrame:
    """(id, print long): one row a document."""
    def work():
        return lambda texts, _: [np.array([fingerprint(t, words) for t in texts], np.uint64).view(np.int64)]

    rows = whole(docs, text, id=F.col(f"`{key}`")).select("id", "body")
    return arrow_pass(rows, "print long", work, keep=["id"])


def as_prints(column: pa.Array) -> np.ndarray:
    return column.to_numpy(zero_copy_only=False).view(np.uint64)


def with_distances(prints: DataFrame) -> DataFrame:
    """(print, near binary): the distance to each reference is a byte."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            table = distances(as_prints(b.column("print")), references())
            yield pa.RecordBatch.from_arrays([b.column("print"), pa.array([r.tobytes() for r in table], pa.binary())], names=["print", "near"])

    return prints.select("print").mapInArrow(run, "print long, near binary")


def with_cells(table: DataFrame, parts: int) -> DataFrame:
    """(print, near, cell): one row a cell that a fingerprint is in."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, len(batch), 4096):
                b = batch.slice(at, 4096)
                made = cells(as_prints(b.column("print")), parts)
                lists = pa.ListArray.from_arrays(np.arange(0, made.size + 1, made.shape[1], dtype=np.int32), pa.array(made.ravel()))
                yield pa.RecordBatch.from_arrays([b.column("print"), b.column("near"), lists], names=["print", "near", "cells"])

    return table.mapInArrow(run, "print long, near binary, cells array<long>").select("print", "near", F.explode("cells").alias("cell"))


def stars(prints: np.ndarray, table: np.ndarray, most: int) -> tuple[list[int], list[int]]:
    """Links of one cell as (fingerprint, least of its group)."""
    i, j = near_pairs(prints, table, most)
    if not len(i):
        return [], []
    least = np.arange(len(prints))
    while True:  # the least place spreads along the links
        before = least.copy()
        np.minimum.at(least, i, least[j])
        np.minimum.at(least, j, least[i])
        if (before == least).all():
            break
    at = np.flatnonzero(least != np.arange(len(prints)))
    signed = prints.view(np.int64)
    return signed[at].tolist(), signed[least[at]].tolist()


def links_of(members: DataFrame, most: int) -> DataFrame:
    """(a, b) of cells (cell, print, near) of few members each."""
    gathered = members.groupBy("cell").agg(F.collect_list("print").alias("prints"), F.collect_list("near").alias("nears")).select("prints", "nears")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            a, b = [], []
            prints, nears = batch.column("prints"), batch.column("nears")
            for k in range(len(batch)):
                own = as_prints(prints[k].values)
                near = np.frombuffer(b"".join(nears[k].values.to_pylist()), np.uint8).reshape(len(own), -1)
                x, y = stars(own, near, most)
                a += x
                b += y
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])

    return gathered.mapInArrow(run, "a long, b long")


def near_links(prints: DataFrame, most: int = MOST) -> DataFrame:
    """(a, b): links that connect all fingerprints (``print``, distinct) at most
    ``most`` bits apart, two at most."""
    if not 0 <= most <= 2:
        raise ValueError("the tables are made for links of at most two bits")
    table, links = staged(with_distances(prints), "distances"), None
    for step, parts in enumerate(PARTS):
        members = staged(with_cells(table, parts), f"cells{step}")
        counts = staged(members.groupBy("cell").agg(F.count("*").alias("n")).where("n > 1"), f"counts{step}")
        last = step == len(PARTS) - 1
        few = counts if last else counts.where(F.col("n") <= FULL)
        found = staged(links_of(members.join(few.select("cell"), "cell"), most), f"links{step}")
        links = found if links is None else links.unionByName(found)
        full = counts.where(F.col("n") > FULL).select("cell")
        if last or full.isEmpty():
            return links
        table = staged(members.join(full, "cell").select("print", "near").distinct(), f"crowded{step}")
    return links


def simhash_duplicates(docs: DataFrame, text: str = "text", key: str = "doc_id", words: int = WORDS, most: int = MOST) -> DataFrame:
    """(id, print long, component): one row a row of ``docs``."""
    signed = staged(fingerprints(docs, text, key, words), "fingerprints")
    classes = staged(signed.groupBy("print").agg(F.min("id").alias("least")), "classes")
    groups = staged(components(near_links(classes, most)), "groups").withColumnsRenamed({"node": "print", "component": "root"})
    rooted = staged(classes.join(groups, "print", "left").select("print", F.coalesce("root", "print").alias("root"), "least"), "rooted")
    named = staged(rooted.groupBy("root").agg(F.min("least").alias("component")), "named")
    by_print = staged(rooted.join(named, "root").select("print", "component"), "by_print")
    return signed.join(by_print, "print").select("id", "print", "component")
