"""Operator 5: near-duplicates by circulant MinHash, banding and exact Jaccard.

Method: each document's set of word shingles gets a signature from two
permutations, the second shifted circularly once a coordinate; bands of the
signature bring alike documents together; every link is confirmed on the whole
sets; linked documents form components.

Groups of any size, without all pairs:
1. equal sets are one class, named by the smallest doc_id; only classes go on;
2. in a band's bucket every class is tested against the bucket's smallest one,
   which links the mass of a group of near copies;
3. in a bucket that still holds several components every class outside the
   largest is tested against some other member of it, HUBS times over, while
   that links anything;
4. classes whose bucket holds more than one component after that are tested by an
   exact prefix filter: two sets of similarity t share one of their rarest
   shingles, and the places of that shingle bound how much they can share. Only
   pairs of different components that pass the bound are made and verified.
No bucket is capped: step 4 covers every pair of a bucket that is left. A link that
step 4 finds need not share a band: it only adds links that hold. A pair of
similarity 0.75 meets in some band but for 2 in a million.

Defined results: a text without words has no set and is linked with nothing;
null text counts as such; rows that repeat a doc_id are judged each by its own
text, and classes named by the same doc_id count as linked; a row without
doc_id is linked with nothing, its component is null and it is kept; an empty
table gives an empty result; the caller's columns are not touched.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from relcheck.llm.circulant import BANDS, ROWS, band_hashes, set_key, signature, word_set
from relcheck.llm.components import components
from relcheck.llm.shared import WordHashes, arrow_pass, staged, whole

#: The table of candidate ids (three longs a row) is broadcast up to this many
#: rows, 24 MB, so that texts need not move to be picked; beyond, they are joined.
FEW_NODES = 1_000_000
#: Rounds of step 3 at most.
HUBS = 3
#: A link: PERCENT of the union is shared, at least.
PERCENT, WORDS = 75, 5


def signatures(docs: DataFrame, text: str = "text", key: str = "doc_id", words: int = WORDS, own: str | None = None) -> DataFrame:
    """(id, twin, n_shingles, set_key binary, bands array<long>); sets without
    shingles have a null set_key. ``twin``: a hash of the text, so that rows
    that repeat a doc_id can be told apart. ``own``: one more column to carry."""
    def work():
        hashes = WordHashes()

        def do(texts, _):
            n, keys, bands = [], [], []
            for t in texts:
                s = word_set(t, hashes, words)
                n.append(len(s))
                keys.append(set_key(s) if len(s) else None)
                bands.append(band_hashes(signature(s), BANDS, ROWS) if len(s) else None)
            return [n, keys, bands]
        return do

    more = [own] if own else []
    rows = whole(docs, text, id=F.col(f"`{key}`"), **{c: F.col(f"`{c}`") for c in more}).select("id", F.xxhash64("body").alias("twin"), "body", *more)
    return arrow_pass(rows, "n_shingles long, set_key binary, bands array<long>", work, keep=["id", "twin", *more])


def whole_sets(docs: DataFrame, nodes: DataFrame, text: str, key: str, words: int) -> DataFrame:
    """(node, twin, shingles array<long>) of the documents in ``nodes`` (node,
    twin, times); rows that occur several times are taken once."""
    def work():
        hashes = WordHashes()
        return lambda texts, _: [[word_set(t, hashes, words).view(np.int64) for t in texts]]

    rows = whole(docs, text, node=F.col(f"`{key}`")).select("node", F.xxhash64("body").alias("twin"), "body")
    if nodes.count() <= FEW_NODES:
        nodes = F.broadcast(nodes)
    single = rows.join(nodes.where("times = 1"), ["node", "twin"], "left_semi")
    several = rows.join(nodes.where("times > 1"), ["node", "twin"], "left_semi").dropDuplicates(["node", "twin"])
    return arrow_pass(single.unionByName(several), "shingles array<long>", work, keep=["node", "twin"])


def shared_enough(a: Column, b: Column, percent: int) -> Column:
    """100 * intersection >= percent * union, on whole sets."""
    both = F.size(F.array_intersect(a, b)).cast("long")
    return 100 * both >= percent * (F.size(a) + F.size(b) - both)


def confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose whole sets are alike enough."""
    left = sets.select(F.col("node").alias("a"), F.col("shingles").alias("of_a"))
    right = sets.select(F.col("node").alias("b"), F.col("shingles").alias("of_b"))
    return pairs.join(right, "b").join(left, "a").where(shared_enough(F.col("of_a"), F.col("of_b"), percent)).select("a", "b")


def sizes_allow(n: Column, m: Column, percent: int) -> Column:
    return (100 * F.least(n, m)) >= (percent * F.greatest(n, m))


def prefix_pairs(items: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b) of different components that may reach ``percent``.

    ``items``: (node, twin, comp, n, s), one row a shingle. Shingles are ordered from
    rare to common; a set's prefix is what it must share some of with any set
    that is alike enough. With a shared shingle at places i and j (from 0), the
    sets share 1 + min(n - i, m - j) - 1 at most."""
    # staged, so that both sides of the joins are exchanges, which a hot shingle can split
    often = staged(items.groupBy("s").agg(F.count("*").alias("df")).where("df > 1"), "often")
    placed = (items.join(often, "s", "left").groupBy("node", "twin", "comp", "n")
              .agg(F.sort_array(F.collect_list(F.struct(F.coalesce("df", F.lit(1)).alias("df"), "s"))).alias("ordered")))
    length = F.expr(f"cast(n - (n * {int(percent)} + 99) div 100 + 1 as int)")
    index = placed.select("node", "comp", "n", F.posexplode(F.slice("ordered", F.lit(1), length)).alias("i", "c")) \
                  .select("node", "comp", "n", "i", "c.s", "c.df").where("df > 1").drop("df")
    index = staged(index, "prefixes")
    # within a list most members are often one component: it is only the right-hand side
    largest = index.groupBy("s", "comp").agg(F.count("*").alias("k")).groupBy("s").agg(F.max_by("comp", F.struct("k", "comp")).alias("mass"), F.count("*").alias("comps")).where("comps > 1")
    index = index.join(staged(largest.select("s", "mass"), "mass"), "s")
    left = index.where("comp != mass").select("s", F.col("node").alias("x"), F.col("comp").alias("cx"), F.col("n").alias("nx"), F.col("i").alias("ix"))
    right = index.select("s", F.col("node").alias("y"), F.col("comp").alias("cy"), F.col("n").alias("ny"), F.col("i").alias("iy"), "mass")
    most = F.least(F.col("nx") - F.col("ix"), F.col("ny") - F.col("iy"))
    enough = (100 + percent) * most >= percent * (F.col("nx") + F.col("ny"))
    once = (F.col("cy") == F.col("mass")) | (F.col("x") < F.col("y"))
    return (left.join(right, "s").where((F.col("cx") != F.col("cy")) & once & sizes_allow(F.col("nx"), F.col("ny"), percent) & enough)
            .select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct())


def hub_pairs(members: DataFrame, k: int) -> DataFrame:
    """(a, b): in every bucket of several components, each member outside the
    largest with one member of the largest, another in each round ``k``. As many
    pairs as members at most. ``members``: (band, node, comp)."""
    of = members.groupBy("band", "comp").agg(F.count("*").alias("n"), F.min_by("node", F.xxhash64("node", F.lit(k))).alias("hub"))
    mass = of.groupBy("band").agg(F.max_by(F.struct("comp", "hub"), F.struct("n", "comp")).alias("mass"), F.count("*").alias("comps")).where("comps > 1")
    mass = staged(mass.select("band", F.col("mass.comp").alias("mass"), F.col("mass.hub").alias("a")), f"mass{k}")
    return members.join(mass, "band").where("comp != mass").select("a", F.col("node").alias("b")).distinct()


def near_duplicates(docs: DataFrame, text: str = "text", key: str = "doc_id", percent: int = PERCENT, words: int = WORDS, own: str | None = None) -> DataFrame:
    """(id, twin, n_shingles, component, kept): one row a row of ``docs``.
    ``own``: one more column to carry, for keys that many equal rows share."""
    signed = staged(signatures(docs, text, key, words, own), "signatures")
    named = signed.where("set_key is not null and id is not null")
    rep = F.min(F.struct("id", "twin"))
    classes = staged(named.groupBy("set_key").agg(rep.alias("rep")).select("set_key", F.col("rep.id").alias("node"), F.col("rep.twin").alias("twin")), "classes")
    # bands of each class, from its first document
    bands = named.join(classes.withColumnsRenamed({"set_key": "of", "twin": "of_twin"}), (F.col("set_key") == F.col("of")) & (F.col("id") == F.col("node")) & (F.col("twin") == F.col("of_twin")))
    bands = (bands.dropDuplicates(["node"]) if own else bands).select("node", "twin", F.explode("bands").alias("band"))
    # staged, so that both sides of the join are exchanges, which a hot bucket can split
    heads = staged(bands.groupBy("band").agg(F.min("node").alias("head"), F.max("node").alias("last")).where("head != last").select("band", "head"), "heads")
    met = staged(bands.join(heads, "band"), "met")  # the members of every bucket of two or more
    spokes = met.where("node != head").select(F.col("head").alias("a"), F.col("node").alias("b")).distinct()
    times = named.groupBy("id", "twin").agg(F.count("*").alias("times")).withColumnsRenamed({"id": "node"})
    nodes = staged(times.join(met.select("node", "twin").distinct(), ["node", "twin"], "left_semi"), "nodes")
    sets = staged(whole_sets(docs, nodes, text, key, words), "sets")
    first = staged(confirmed(spokes, sets, percent), "spokes")
    links, grouped = first, staged(components(first), "first")
    comp = F.coalesce("component", "node").alias("comp")
    for k in range(HUBS):
        members = met.join(grouped, "node", "left").select("band", "node", comp)
        found = staged(confirmed(hub_pairs(members, k), sets, percent), f"hubs{k}")
        if found.isEmpty():
            break
        links = links.unionByName(found)
        grouped = staged(components(links), f"grouped{k}")
    members = met.join(grouped, "node", "left").select("band", "node", comp)
    open_bands = members.groupBy("band").agg(F.min("comp").alias("low"), F.max("comp").alias("high")).where("low != high").select("band")
    rest = staged(members.join(open_bands, "band", "left_semi").select("node", "comp").distinct(), "rest")
    items = sets.join(rest, "node").select("node", "twin", "comp", F.size("shingles").cast("long").alias("n"), F.explode("shingles").alias("s"))
    second = confirmed(staged(prefix_pairs(items, percent), "pairs"), sets, percent)
    # the links of all steps make the components; then every document by its class
    links = links.unionByName(second)
    groups = staged(components(links), "groups").withColumnRenamed("node", "of_node")
    by_class = classes.join(groups, F.col("node") == F.col("of_node"), "left").select(F.col("set_key").alias("of_key"), F.coalesce("component", "node").alias("component"))
    out = signed.join(by_class, F.col("set_key") == F.col("of_key"), "left").select(
        *([own] if own else []), "id", "twin", "n_shingles", F.when(F.col("id").isNull(), F.col("id")).otherwise(F.coalesce("component", "id")).alias("component"))
    return out.withColumn("kept", F.col("id").eqNullSafe(F.col("component")))


def first_of_each(docs: DataFrame, text: str = "text", key: str = "doc_id", percent: int = PERCENT, words: int = WORDS) -> DataFrame:
    """The documents that stay: one of each component, own columns. What goes
    is named by (id, text hash) and taken out by an anti-join; rows that repeat
    a kept doc_id are one group as well, and the first by hash stays."""
    verdict = staged(near_duplicates(docs, text, key, percent, words), "verdict")
    gone = verdict.where("not kept").select(F.col("id").alias("_id"), F.col("twin").alias("_twin")).distinct()
    twin = F.xxhash64(F.coalesce(F.col(f"`{text}`"), F.lit("")).cast("binary"))
    left = docs.join(gone, (F.col(f"`{key}`") == F.col("_id")) & (twin == F.col("_twin")), "left_anti")
    again = staged(verdict.where("kept and id is not null").groupBy("id").agg(F.count("*").alias("n")).where("n > 1").select(F.col("id").alias("_id")), "again")
    same = F.col(f"`{key}`") == F.col("_id")
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    one = left.join(again, same, "left_semi").groupBy(F.col(f"`{key}`").alias("_id")).agg(F.min_by(row, F.xxhash64(row)).alias("_row")).select("_row.*")
    return left.join(again, same, "left_anti").unionByName(one)


def one_of_each(docs: DataFrame, text: str = "text", key: str = "doc_id", percent: int = PERCENT, words: int = WORDS) -> DataFrame:
    """The documents that stay, own columns: one row of each component of
    texts, that of the smallest id, then text hash, then row hash. A node is 128
    bits of an id with its text, so equal ids alone neither link nor drop texts, and
    null ids (the last to stay) are compared like others. A text without words
    is linked with nothing; rows equal in id and text are one document."""
    id_, twin = F.col(f"`{key}`"), F.xxhash64(F.coalesce(F.col(f"`{text}`"), F.lit("")).cast("binary"))
    named_by = F.concat_ws(":", F.coalesce(F.length(id_.cast("string")).cast("string"), F.lit("null")), id_.cast("string"), F.md5(F.coalesce(F.col(f"`{text}`"), F.lit("")).cast("binary")))
    nodes = docs.select(F.unhex(F.md5(named_by.cast("binary"))).alias("node"), id_.alias("own"), F.col(f"`{text}`").alias("text"))
    verdict = staged(near_duplicates(nodes, "text", "node", percent, words, own="own"), "verdict")
    rank = F.struct(F.col("own").isNull().alias("last"), "own", "twin")
    named = verdict.groupBy("component", "own", "twin").agg(F.count("*").alias("n"))  # a row a node
    named = staged(named.select("component", "n", rank.alias("rank")), "named")
    # staged, so that both sides of the join are exchanges, which a hot component can split
    best = staged(named.groupBy("component").agg(F.min("rank").alias("best")), "best")
    judged = staged(named.join(best, "component").select(F.col("rank.own").alias("_id"), F.col("rank.twin").alias("_twin"), "n", (F.col("rank") == F.col("best")).alias("stays")), "judged")
    same = id_.eqNullSafe(F.col("_id")) & (twin == F.col("_twin"))
    left = docs.join(judged.where("not stays or n > 1").select("_id", "_twin"), same, "left_anti")
    # staged, so that many equal rows are aggregated where they are read and not in one task
    again = staged(docs.join(judged.where("stays and n > 1").select("_id", "_twin"), same, "left_semi"), "again")
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    one = again.groupBy(id_.alias("_id"), twin.alias("_twin")).agg(F.min_by(row, F.xxhash64(row)).alias("_row")).select("_row.*")
    return left.unionByName(one)
