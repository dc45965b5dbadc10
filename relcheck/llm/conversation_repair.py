"""Operator 12: conversation structure repair by Four-Russians block tables.

Method: each row of a conversation becomes a symbol (role, and its first fault);
the cheapest edits that make the roles an optional system row and then user and
assistant in turns are found by tables over blocks of symbols (see
``block_tables.py``): one lookup a block from the end of the conversation, then
the blocks are expanded into edits, of equally cheap ones the ASCII-least.

Faults, the first that holds: blank (nothing but white space), duplicate (role
and text were there before), truncated (the last character that is not white
space is none of .!?). Edits: keep 0, rerole to user or assistant 1, delete 2
(blank and duplicate rows must go), insert an empty user or assistant row 5; a
truncated row that stays costs 5 more.

A conversation of any length, even of a third of all rows: equal rows are one
row with a count; rows are put in order by a range exchange, which cuts a long
conversation over many tasks; each task writes pieces of at most PIECE symbols.
A piece that is not a whole conversation is first solved for each of four ways
to end (a 4 x 4 table of costs), a conversation's few tables are chained from its
end, then every such piece is expanded for each of four ways to begin, and the
right one is picked along the chain. Texts move by row number only for rows that
stay.

Order: by turn (nulls first), then role, then the md5 of the text. Defined
results: null roles and texts are one space (such a role cannot be kept, such a
text is blank); rows without conversation are one conversation; an empty table
gives empty results; columns besides the four named are not carried.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from relcheck.llm.block_tables import EMPTY, GONE, OTHER, closing, lowered, tables
from relcheck.llm.shared import staged

#: Symbols of a piece at most.
PIECE = 1 << 16
#: White space, and what ends a text that is not cut short.
SPACE = " \t\n\x0b\x0c\r"
ENDS = ".!?"
ROLES = ("", "user", "assistant")
KEPT, AS_USER, AS_ASSISTANT = range(3)


class Repair(NamedTuple):
    #: (conv, gaps, blank, duplicate, truncated, illegal, cost, audit): one row a conversation
    verdict: DataFrame
    #: (conv, part, number, place, turn, role, text, edit): the rows of the
    #: repaired conversations, in the order of the three numbers
    rows: DataFrame


def distinct_rows(convs: DataFrame, conv: str, turn: str, role: str, text: str) -> DataFrame:
    """(conv, turn, role, text, n, row): equal rows once, numbered."""
    space = F.lit(" ")
    rows = convs.select(F.col(f"`{conv}`").alias("conv"), F.col(f"`{turn}`").alias("turn"),
                        F.coalesce(F.col(f"`{role}`"), space).alias("role"), F.coalesce(F.col(f"`{text}`"), space).alias("text"))
    counted = rows.groupBy("conv", "turn", "role", "text").agg(F.count("*").alias("n"))
    return staged(counted.withColumn("row", F.monotonically_increasing_id()), "rows")


def marked(rows: DataFrame) -> DataFrame:
    """(conv, turn, role, text_id, row, n, kind, blank, again, cut): ``kind`` is
    the role's class, ``again`` that an earlier turn has the same role and text."""
    end = F.rtrim("text", F.lit(SPACE))
    initial = F.left("role", F.lit(1))
    kind = F.when(initial == "s", 0).when(initial == "u", 1).when(initial == "a", 2).otherwise(OTHER)
    slim = rows.select("conv", "turn", "role", F.md5("text").alias("text_id"), "row", "n", kind.alias("kind"),
                       (end == "").alias("blank"), (~F.right(end, F.lit(1)).isin(*ENDS)).alias("cut"))
    slim = staged(slim, "slim")
    place = F.struct(F.col("turn").isNotNull().alias("known"), "turn")
    same = [F.col("conv").alias("of"), F.col("role").alias("of_role"), F.col("text_id").alias("of_text")]
    repeats = slim.where("not blank").groupBy(*same).agg(F.min(place).alias("first"), F.count("*").alias("turns")).where("turns > 1")
    repeats = staged(repeats.select("of", "of_role", "of_text", "first"), "repeats")
    on = F.col("conv").eqNullSafe(F.col("of")) & (F.col("role") == F.col("of_role")) & (F.col("text_id") == F.col("of_text"))
    again = F.coalesce(place != F.col("first"), F.lit(False)) & ~F.col("blank")
    return staged(slim.join(repeats, on, "left").select(*slim.columns, again.alias("again")), "marked")


def counts(rows: DataFrame) -> DataFrame:
    """(conv, gaps, blank, duplicate, truncated)."""
    n, gone = F.col("n"), F.col("again") | F.col("blank")
    by_turn = rows.groupBy("conv", "turn").agg(
        F.sum(F.when(F.col("blank"), n).otherwise(0)).alias("blank"),
        F.sum(F.when(F.col("blank"), 0).when(F.col("again"), n).otherwise(n - 1)).alias("duplicate"),
        F.sum((~gone & F.col("cut")).cast("long")).alias("truncated"))
    wide = T.DecimalType(38, 0)
    gaps = F.max("turn").cast(wide) - F.min("turn").cast(wide) + 1 - F.count("turn")
    return by_turn.groupBy("conv").agg(F.coalesce(gaps, F.lit(0)).try_cast("long").alias("gaps"), *[F.sum(c).alias(c) for c in ("blank", "duplicate", "truncated")])


def arrow(df: DataFrame, schema: T.StructType, work: Callable[[Iterator[pa.RecordBatch]], Iterator[list[tuple]]]) -> DataFrame:
    """mapInArrow with a function that gives lists of row tuples."""
    made = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in work(batches):
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True) if rows else [[]] * len(made), made.types, strict=True)], schema=made)

    return df.mapInArrow(run, schema)


def records(batches: Iterator[pa.RecordBatch], *names: str) -> Iterator[tuple]:
    for b in batches:
        yield from zip(*(b.column(n).to_pylist() for n in names), strict=True)


def pieces(rows: DataFrame, size: int) -> DataFrame:
    """(conv, part, number, whole, codes binary, rows array<long>): the symbols
    (four times the fault, plus the role's class) of every conversation in
    order, and the row numbers of the symbols (-1: a further copy). ``whole``:
    the conversation's only piece."""
    schema = T.StructType([rows.schema["conv"], *T._parse_datatype_string("part int, number long, whole boolean, codes binary, rows array<long>").fields])

    def work(batches):
        part, out, held, total = TaskContext.get().partitionId(), [], 0, 0
        conv, codes, numbers, began, started = None, bytearray(), [], False, False  # began: the conversation surely starts here

        def piece(ended):
            nonlocal codes, numbers, held, total
            out.append((conv, part, total, began and ended, bytes(codes), numbers))
            held, total, codes, numbers = held + len(codes), total + 1, bytearray(), []

        for c, kind, blank, again, cut, n, row in records(batches, "conv", "kind", "blank", "again", "cut", "n", "row"):
            if not started or c != conv:
                if started:
                    piece(True)
                conv, began, started = c, started, True
            first = 8 + kind if blank or again else 4 + kind if cut else kind
            for code, copies, number in ((first, 1, row), (8 + kind, n - 1, -1)):
                while copies:
                    if len(codes) == size:
                        piece(False)
                        began = False
                    if held >= 4 * size:
                        yield out
                        out, held = [], 0
                    k = min(copies, size - len(codes))
                    codes += bytes([code]) * k
                    numbers += [number] * k
                    copies -= k
        if started:
            piece(False)  # the next task may go on with it
        yield out

    order = ["conv", "turn", "role", "text_id"]
    ranged = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    return staged(arrow(ranged.select("conv", "kind", "blank", "again", "cut", "n", "row"), schema, work), "pieces")


def symbols(codes: bytes) -> np.ndarray:
    return np.minimum(np.frombuffer(codes, np.uint8).astype(np.int64), GONE)


def illegal(codes: bytes) -> int:
    """Neighbouring roles that are not system-user, user-assistant, assistant-user."""
    kinds = np.frombuffer(codes, np.uint8).astype(np.int64) % 4
    return int((~np.isin(kinds[:-1] * 4 + kinds[1:], (1, 6, 9))).sum())


def traced(codes: bytes, rows: list[int], end: int, state: int, last: bool) -> tuple[str, int, list[tuple]]:
    """(letters, state after, rows that stay as (place, row or none, role))."""
    letters, after = tables().trace(symbols(codes), end, state)
    if last:
        letters += closing(after)
    stays, i, now = [], 0, state
    system = np.frombuffer(codes, np.uint8) % 4 == 0
    for place, x in enumerate(letters):
        if x in "IRK":
            if x == "K" and system[i]:
                role, now = KEPT, 1
            else:
                now = 3 if now == 2 else 2
                role = KEPT if x == "K" else AS_USER if now == 2 else AS_ASSISTANT
            stays.append({"place": place, "row": None if x == "I" else rows[i], "role": role})
        i += x != "I"
    return letters, after, stays


STAYS = "array<struct<place: long, row: long, role: int>>"


def whole_ones(found: DataFrame) -> DataFrame:
    """(conv, part, number, cost, illegal, audit, stays) of conversations that
    are one piece."""
    schema = T.StructType([found.schema["conv"], *T._parse_datatype_string(f"part int, number long, cost long, illegal long, audit string, stays {STAYS}").fields])

    def work(batches):
        t, out = tables(), []
        for conv, part, number, codes, rows in records(batches, "conv", "part", "number", "codes", "rows"):
            letters, _, stays = traced(codes, rows, t.end, EMPTY, True)
            out.append((conv, part, number, t.costs(symbols(codes), t.end)[EMPTY], illegal(codes), letters, stays))
            if len(out) == 512:
                yield out
                out = []
        yield out

    return arrow(found.where("whole").select("conv", "part", "number", "codes", "rows"), schema, work)


def chained_ones(found: DataFrame) -> DataFrame:
    """The same of pieces that may be parts of a conversation."""
    conv = found.schema["conv"]
    loose = staged(found.where("not whole").select("conv", "part", "number", "codes", "rows"), "loose")
    piece = "part int, number long"

    def solved(batches):  # the costs from each state before to each state after
        t = tables()
        for c, part, number, codes in records(batches, "conv", "part", "number", "codes"):
            s = symbols(codes)
            costs = [x for e in t.ends for x in t.costs(s, e)]
            yield [(c, part, number, costs, illegal(codes), codes[0] % 4, codes[-1] % 4)]

    costs = arrow(loose.select("conv", "part", "number", "codes"),
                  T.StructType([conv, *T._parse_datatype_string(f"{piece}, costs array<int>, illegal long, first int, last int").fields]), solved)
    chains = costs.groupBy("conv").agg(F.sort_array(F.collect_list(F.struct("part", "number", "costs", "illegal", "first", "last"))).alias("chain"))

    def ends(batches):  # from the end: the vector behind every piece
        t = tables()
        for (chain,) in records(batches, "chain"):
            v, total, out = t.end, 0, []
            for k in range(len(chain) - 1, -1, -1):
                p, last = chain[k], k == len(chain) - 1
                after = t.vectors[v]
                now, less = lowered([min(p["costs"][4 * e + q] + after[e] for e in range(4)) for q in range(4)])
                broken = p["illegal"] + (not last and (p["last"], chain[k + 1]["first"]) not in ((0, 1), (1, 2), (2, 1)))
                out.append([p["part"], p["number"], v, last, None, broken])
                v, total = t.number[now], total + less
            out[-1][4] = total + now[EMPTY]  # the whole cost, on the first piece
            yield [tuple(x) for x in out]

    behind = staged(arrow(chains.select("chain"), T._parse_datatype_string(f"{piece}, behind int, final boolean, cost long, illegal long"), ends), "behind")

    def expanded(batches):  # for each state before
        for c, part, number, codes, rows, end, final, cost, bad in records(batches, "conv", "part", "number", "codes", "rows", "behind", "final", "cost", "illegal"):
            ways = [traced(codes, rows, end, q, final) for q in range(4)]
            yield [(c, part, number, cost, bad, [w[1] for w in ways], [{"audit": w[0], "stays": w[2]} for w in ways])]

    ways = staged(arrow(loose.join(behind, ["part", "number"]),
                        T.StructType([conv, *T._parse_datatype_string(f"{piece}, cost long, illegal long, exits array<int>, ways array<struct<audit: string, stays: {STAYS}>>").fields]),
                        expanded), "ways")
    walks = ways.groupBy("conv").agg(F.sort_array(F.collect_list(F.struct("part", "number", "exits"))).alias("walk")).select("walk")

    def walked(batches):
        for (walk,) in records(batches, "walk"):
            state, out = EMPTY, []
            for p in walk:
                out.append((p["part"], p["number"], state))
                state = p["exits"][state]
            yield out

    begins = staged(arrow(walks, T._parse_datatype_string(f"{piece}, state int"), walked), "begins")
    way = F.col("ways")[F.col("state")]
    return ways.join(begins, ["part", "number"]).select("conv", "part", "number", "cost", "illegal", way["audit"].alias("audit"), way["stays"].alias("stays"))


def repair(convs: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text", size: int = PIECE) -> Repair:
    rows = distinct_rows(convs, conv, turn, role, text)
    slim = marked(rows)
    found = pieces(slim, size)
    done = staged(whole_ones(found).unionByName(chained_ones(found)), "done")
    audits = done.groupBy("conv").agg(F.sum("cost").alias("cost"), F.sum("illegal").alias("illegal"),
                                      F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("part", "number", "audit"))), lambda p: p["audit"]), "").alias("audit"))
    told = audits.withColumnRenamed("conv", "of")
    verdict = counts(slim).join(told, F.col("conv").eqNullSafe(F.col("of"))).select("conv", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit")

    stay = staged(done.select("conv", "part", "number", F.explode("stays").alias("at")).select("conv", "part", "number", "at.*"), "stays")
    named = F.when(F.col("stays_as") == AS_USER, "user").when(F.col("stays_as") == AS_ASSISTANT, "assistant")
    stay = stay.withColumnRenamed("role", "stays_as")
    own = stay.where("row is not null").join(rows.select("row", "turn", F.col("role").alias("was"), "text"), "row").select(
        "conv", "part", "number", "place", "turn", F.coalesce(named, "was").alias("role"), "text", F.when(F.col("stays_as") == KEPT, "K").otherwise("R").alias("edit"))
    new = stay.where("row is null").select("conv", "part", "number", "place", F.lit(None).cast(rows.schema["turn"].dataType).alias("turn"), named.alias("role"), F.lit("").alias("text"), F.lit("I").alias("edit"))
    return Repair(verdict, own.unionByName(new))


def digests(rows: DataFrame) -> DataFrame:
    """(conv, sha256): hash of a repaired conversation's ``role:text`` lines.
    Such a hash can only be made from first to last, so a conversation is read
    by one task; its lines stream through, none are held."""
    schema = T.StructType([rows.schema["conv"], T.StructField("sha256", T.StringType())])

    def work(batches):
        now, conv, out = None, None, []
        for c, role, text in records(batches, "conv", "role", "text"):
            if now is None or c != conv:
                if now:
                    out.append((conv, now.hexdigest()))
                conv, now = c, hashlib.sha256()
            else:
                now.update(b"\n")
            now.update(f"{role}:{text}".encode())
            if len(out) == 1024:
                yield out
                out = []
        if now:
            out.append((conv, now.hexdigest()))
        yield out

    ordered = rows.repartition("conv").sortWithinPartitions("conv", "part", "number", "place")
    return arrow(ordered.select("conv", "role", "text"), schema, work)


def damaged(convs: DataFrame) -> DataFrame:
    """(conv_id, turn, role, text): a trial of the operator, which harms one row
    in four. By crc32 of ``conv_id:turn`` modulo 20, nulls as one space: 0 the
    row is dropped, 1 its text is emptied, 2 it loses its .!?, 3 it is there
    twice, 4 its role is user."""
    space = F.lit(" ")

    def word(c: str) -> Column:
        return F.coalesce(F.col(c).cast("string"), space)

    harm = F.crc32(F.concat(word("conv_id"), F.lit(":"), word("turn")).cast("binary")) % 20
    text = F.when(F.col("harm") == 1, "").when(F.col("harm") == 2, F.translate(word("text"), ENDS, "")).otherwise(word("text"))
    role = F.when(F.col("harm") == 4, "user").otherwise(word("role"))
    kept = convs.withColumn("harm", harm).where("harm != 0").select("conv_id", "turn", role.alias("role"), text.alias("text"), "harm")
    return kept.withColumn("_", F.explode(F.expr("sequence(1, if(harm = 3, 2, 1))"))).select("conv_id", "turn", "role", "text")
