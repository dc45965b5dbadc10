import hashlib
import itertools
import random
import re
import zlib
from collections import defaultdict

import numpy as np
import pytest

import __spark_entry__ as E
from relcheck.llm.block_tables import closing, tables
from relcheck.llm.conversation_repair import damaged, digests, repair
from relcheck.llm.queries import ORACLE
from tests.conftest import SF

WANTED = re.compile(r"(s?(ua)+)?\Z")
SCHEMA = "conv_id long, turn long, role string, text string, conv string, row string, n string, stays string, `a b` string"
MORE = ("c", "r", "n", "s", "ab")


def cheapest(rows):
    """(cost, audit, roles) by trying every edit of every row, rows put in as
    well. rows: (initial, fault: '' | 'cut' | 'gone')."""
    best = None
    for puts in itertools.product(range(3), repeat=len(rows) + 1):
        if sum(puts) > 3:
            continue
        for letters in itertools.product("DKR", repeat=len(rows)):
            audit, cost, slots = "", 0, []
            for k, (x, n) in enumerate(zip([*letters, ""], puts, strict=True)):
                audit += "I" * n + x
                cost += 5 * n
                slots += ["ua"] * n
                if x == "D":
                    cost += 2
                elif x:
                    initial, fault = rows[k]
                    if fault == "gone":
                        cost = 10 ** 6
                    cost += (x == "R") + 5 * (fault == "cut")
                    slots.append("ua" if x == "R" else initial)
            if best and (cost, audit) >= best[:2]:
                continue
            for made in itertools.product(*slots):
                if WANTED.match("".join(made)):
                    best = (cost, audit, "".join(made))
                    break
    return best


CODE = {"s": 0, "u": 1, "a": 2, "t": 3}
FAULT = {"": 0, "cut": 4, "gone": 8}


@pytest.mark.parametrize("n", range(5))
def test_tables_equal_trying_all_edits(n):
    r = random.Random(n)
    every = list(itertools.product(itertools.product("suat", ("", "cut", "gone")), repeat=n))
    for rows in r.sample(every, min(len(every), [1, 12, 60, 40, 12][n])):
        codes = np.array([min(CODE[i] + FAULT[f], 8) for i, f in rows], np.int64)
        letters, state = tables().trace(codes, tables().end)
        assert (tables().costs(codes, tables().end)[0], letters + closing(state)) == cheapest(rows)[:2]


def step_by_step(rows):
    """(cost, audit) of a long sequence, rows one after another from the last;
    what is cheapest from each of '', 's', 'u', 'a' as the last role."""
    goes = {"": "su", "s": "u", "u": "a", "a": "u"}

    def put_in(best):
        for _ in range(3):
            for q in goes:
                to = goes[q][-1]
                best[q] = min(best[q], (best[to][0] + 5, "I" + best[to][1]))
        return best
    best = put_in({"": (0, ""), "s": (99, ""), "u": (99, ""), "a": (0, "")})
    for initial, fault in reversed(rows):
        now = {}
        for q in goes:
            ways = [(best[q][0] + 2, "D" + best[q][1])]
            if fault != "gone":
                more = 5 * (fault == "cut")
                to = goes[q][-1]
                ways.append((best[to][0] + 1 + more, "R" + best[to][1]))
                if initial and initial in goes[q]:
                    ways.append((best[initial][0] + more, "K" + best[initial][1]))
            now[q] = min(ways)
        best = put_in(now)
    return best[""]


def brute(rows):
    """{conv: (gaps, blank, duplicate, truncated, illegal, cost, audit, sha)} of
    (conv, turn, role, text) rows."""
    convs = defaultdict(list)
    for c, t, role, text in rows:
        convs[c].append((t is not None, t or 0, " " if role is None else role, hashlib.md5((" " if text is None else text).encode()).hexdigest(),
                         " " if text is None else text, t))
    out = {}
    for c, own in convs.items():
        own.sort(key=lambda x: x[:4])
        seen, judged = set(), []
        for _, _, role, _, text, _ in own:
            body = text.rstrip(" \t\n\x0b\x0c\r")
            fault = "blank" if not body else "duplicate" if (role, text) in seen else "truncated" if body[-1] not in ".!?" else ""
            seen.add((role, text))
            judged.append((role[:1], fault))
        n = lambda f: sum(x == f for _, x in judged)
        pairs = [a[0] + b[0] for a, b in itertools.pairwise(judged)]
        cost, audit = step_by_step([(i, "cut" if f == "truncated" else "gone" if f else "") for i, f in judged])
        lines, i, last = [], 0, ""
        for x in audit:
            if x != "D":
                turn = "a" if last == "u" else "u"
                role, text = (own[i][2], own[i][4]) if x == "K" else ({"u": "user", "a": "assistant"}[turn], own[i][4] if x == "R" else "")
                last = role[:1]
                lines.append(f"{role}:{text}")
            i += x != "I"
        assert WANTED.match("".join(x[0] for x in lines))
        turns = [x[5] for x in own if x[5] is not None]
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        out[c] = (gaps, n("blank"), n("duplicate"), n("truncated"), sum(p not in ("su", "ua", "au") for p in pairs), cost, audit,
                  hashlib.sha256("\n".join(lines).encode()).hexdigest())
    return out


def solved(spark, rows, **options):
    made = repair(spark.createDataFrame([(*r, *MORE) for r in rows], SCHEMA), **options)
    hashes = {r.conv: r.sha256 for r in digests(made.rows).collect()}
    none = hashlib.sha256(b"").hexdigest()
    return {r.conv: (*tuple(r)[1:], hashes.get(r.conv, none)) for r in made.verdict.collect()}


def awkward(r, n, convs):
    texts = ["Hello there.", "no end", "what?", "", " \n\t", None, "Hello there.", "ends! \n", "東京。", "x" * 5000 + "."]
    roles = ["user", "assistant", "system", "user", "assistant", "tool", None, "", "User", "unknown"]
    text = lambda: r.choice(texts) if r.random() < 0.4 else f"line {r.randrange(9999)}{r.choice(['.', '', '!'])}"
    return [(r.choice(convs), r.choice([None, *range(-3, 40)]), r.choice(roles[:5] if r.random() < 0.8 else roles), text()) for _ in range(n)]


@pytest.mark.parametrize("seed,size", [(0, 1 << 16), (1, 5), (2, 1)])
def test_equals_brute_force(spark, seed, size):
    """Nulls, ties, equal rows, odd roles; with small pieces every conversation is chained."""
    rows = awkward(random.Random(seed), 400, [None, *range(25)])
    assert solved(spark, rows, size=size) == brute(rows)


def test_a_conversation_of_a_third_of_all_rows(spark):
    r = random.Random(4)
    rows = awkward(r, 300, range(40))
    rows += [(7, t, r.choice(["user", "assistant"]), f"{t}.") for t in range(1500)] + [(8, 3, "user", "the same row.")] * 900
    got = solved(spark, rows, size=64)
    assert got == brute(rows)
    assert len(got[8][6]) >= 900


def test_empty_and_one_row(spark):
    empty = spark.createDataFrame([], SCHEMA)
    made = repair(empty)
    assert made.verdict.count() == made.rows.count() == digests(made.rows).count() == 0
    assert solved(spark, [(1, None, None, None)]) == brute([(1, None, None, None)])
    assert solved(spark, [(None, 9, "user", "hi.")]) == brute([(None, 9, "user", "hi.")])


def test_gaps_beyond_a_long(spark):
    lo, hi = -(1 << 63), (1 << 63) - 1
    assert solved(spark, [(1, lo, "user", "a."), (1, hi, "assistant", "b.")])[1][0] is None


def test_rows_of_a_repair(spark):
    rows = [(1, 0, "system", "be kind."), (1, 1, "user", "a."), (1, 2, "user", "b."), (1, 3, "user", "c."), (1, 4, "assistant", "")]
    made = repair(spark.createDataFrame([(*r, *MORE) for r in rows], SCHEMA))
    got = [(r.role, r.text, r.edit, r.turn) for r in made.rows.orderBy("part", "number", "place").collect()]
    assert got == [("system", "be kind.", "K", 0), ("user", "b.", "K", 2), ("assistant", "c.", "R", 3)]
    assert made.verdict.first().audit == "KDKRD"


def harmed(rows):
    out = []
    for c, t, role, text in rows:
        role, text = " " if role is None else role, " " if text is None else text
        harm = zlib.crc32(f"{' ' if c is None else c}:{' ' if t is None else t}".encode()) % 20
        if harm:
            text = "" if harm == 1 else re.sub("[.!?]", "", text) if harm == 2 else text
            out += [(c, t, "user" if harm == 4 else role, text)] * (2 if harm == 3 else 1)
    return out


def test_damage_and_sql_on_awkward_rows(spark):
    import duckdb
    import pandas as pd
    rows = [(c, t, role, text) for i, (c, t, role, text) in enumerate(awkward(random.Random(9), 400, [None, *range(60)]))]
    rows = list({(c, t): x for x in rows for c, t in [x[:2]]}.values()) + [(-5, 0, "user", "x.")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    key = lambda r: tuple((x is not None, x) for x in r)
    assert sorted((tuple(r) for r in damaged(df).collect()), key=key) == sorted(harmed(rows), key=key)
    want = brute(harmed(rows))
    con = duckdb.connect()
    frame = pd.DataFrame(rows, columns=["conv_id", "turn", "role", "text"]).astype({"conv_id": "Int64", "turn": "Int64"})  # noqa: F841
    con.execute("CREATE TABLE conversations AS SELECT conv_id::BIGINT AS conv_id, turn::BIGINT AS turn, role, text FROM frame")
    got = {r[0]: r[1:] for r in con.sql(ORACLE["op12_conversation_repair"]).fetchall()}
    assert {c: x for c, x in got.items() if c in want} == want
    assert all(x[:7] == (0,) * 6 + ("",) for c, x in got.items() if c not in want)


def test_query_equals_brute_force(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    got = {r[0]: tuple(r)[1:] for r in E.queries()["op12_conversation_repair"](spark, SF).collect()}
    want = brute(harmed(rows))
    none = (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())
    assert got == {r[0]: want.get(r[0], none) for r in rows}
