"""Cheapest repair of a sequence of rows by tables over blocks of rows.

A row is one of ten symbols (role and fault; the tenth stands for no row). What
a repair may have written so far is one of four states, so the cost of the rest
is a vector of four numbers. Less its least number, that vector takes few
values. For each of them and every possible block of BLOCK symbols a table holds
the vector before the block and what was taken off, so a sequence is solved from
its end by one lookup a block. Then blocks are expanded from the front, at each
row with the letter that is the first in ASCII of those that lead to the least
cost: costs to go are exact, so ties are settled by the letters alone.
"""

from __future__ import annotations

from functools import cache

import numpy as np

#: States: nothing written, a system row, a user row, an assistant row.
EMPTY, SYSTEM, USER, ASSISTANT = range(4)
ACCEPTED = (EMPTY, ASSISTANT)
#: Classes of roles by initial; a symbol is a class, the same cut short (+ 4),
#: a row that must go, or no row.
S, U, A, OTHER = range(4)
GONE, NOTHING, SYMBOLS = 8, 9, 10
KEEP, REROLE, DELETE, INSERT, CUT = 0, 1, 2, 5, 5
BLOCK = 4
NEVER = 1 << 20
#: The state after a user or assistant row, whichever may come next.
NEXT = (USER, USER, ASSISTANT, USER)


def kept(state: int, role: int) -> int | None:
    """The state after a kept row, or none where it may not stand."""
    if role == S:
        return SYSTEM if state == EMPTY else None
    if role == U:
        return USER if state != USER else None
    return ASSISTANT if role == A and state == USER else None


def closed(costs: list[int]) -> list[int]:
    """With rows put in at this place."""
    for _ in range(3):
        costs = [min(c, INSERT + costs[NEXT[q]], NEVER) for q, c in enumerate(costs)]
    return costs


def edges(symbol: int, state: int, after: tuple) -> list[tuple[str, int, int]]:
    """(letter, cost to the end, next state) of a row."""
    out = [("D", DELETE + after[state], state)]
    if symbol < GONE:
        cut = CUT if symbol >= 4 else 0
        if (to := kept(state, symbol % 4)) is not None:
            out.append(("K", KEEP + cut + after[to], to))
        out.append(("R", REROLE + cut + after[NEXT[state]], NEXT[state]))
    return out


def before(symbol: int, after: tuple) -> list[int]:
    """Costs to go before a row from those after it."""
    if symbol == NOTHING:
        return closed(list(after))
    return closed([min(c for _, c, _ in edges(symbol, q, after)) for q in range(4)])


def lowered(costs: list[int]) -> tuple[tuple, int]:
    least = min(costs)
    return tuple(NEVER if c >= NEVER // 2 else c - least for c in costs), least


class Tables:
    def __init__(self):
        self.vectors: list[tuple] = []
        self.number: dict[tuple, int] = {}
        ends = [closed([0 if q in ACCEPTED else NEVER for q in range(4)])] + [[0 if q == e else NEVER for q in range(4)] for e in range(4)]
        self.end, *self.ends = [self._named(lowered(e)[0]) for e in ends]
        steps, i = [], 0
        while i < len(self.vectors):  # vectors that are met on the way are appended
            made = [lowered(before(s, self.vectors[i])) for s in range(SYMBOLS)]
            steps.append([(self._named(v), off) for v, off in made])
            i += 1
        one = np.array(steps)
        self.step, self.step_off = one[:, :, 0], one[:, :, 1]
        to, off = self.step, self.step_off
        for _ in range(BLOCK - 1):  # one more symbol in front
            off = (off[:, None, :] + self.step_off[to].transpose(0, 2, 1)).reshape(len(to), -1)
            to = self.step[to].transpose(0, 2, 1).reshape(len(to), -1)
        self.to, self.off = to.astype(np.int32), off.astype(np.int32)
        self.expanded: dict[tuple[int, int, int], tuple[str, int]] = {}

    def _named(self, v: tuple) -> int:
        if v not in self.number:
            self.number[v] = len(self.vectors)
            self.vectors.append(v)
        return self.number[v]

    def blocks(self, symbols: np.ndarray) -> list[int]:
        full = np.full(-(-len(symbols) // BLOCK) * BLOCK, NOTHING, np.int64)
        full[:len(symbols)] = symbols
        return (full.reshape(-1, BLOCK) @ (SYMBOLS ** np.arange(BLOCK - 1, -1, -1))).tolist()

    def solve(self, blocks: list[int], end: int) -> tuple[list[int], int]:
        """(vector before every block and the one at the end, all that was
        taken off)."""
        v, total, at = end, 0, [end]
        for b in reversed(blocks):
            total += int(self.off[v, b])
            v = int(self.to[v, b])
            at.append(v)
        return at[::-1], total

    def costs(self, symbols: np.ndarray, end: int) -> list[int]:
        """Cost to go from every state before ``symbols``."""
        at, total = self.solve(self.blocks(symbols), end)
        return [min(c + total, NEVER) for c in self.vectors[at[0]]]

    def expand(self, block: int, after: int, state: int) -> tuple[str, int]:
        """(letters, next state) through a block that ``after`` follows."""
        key = (block, after, state)
        if key not in self.expanded:
            symbols, v, ahead = [block // SYMBOLS ** k % SYMBOLS for k in range(BLOCK)], after, []
            for s in symbols:  # from the last
                ahead.append(v)
                v = int(self.step[v, s])
            letters = ""
            for s, v in zip(reversed(symbols), reversed(ahead), strict=True):
                to = self.vectors[v]
                here = before(s, to)
                while True:
                    ways = [("", to[state], state)] if s == NOTHING else edges(s, state, to)
                    ways.append(("I", INSERT + here[NEXT[state]], NEXT[state]))
                    letter, state = min((x, q) for x, c, q in ways if c == here[state])
                    letters += letter
                    if letter != "I":
                        break
            self.expanded[key] = (letters, state)
        return self.expanded[key]

    def trace(self, symbols: np.ndarray, end: int, state: int = EMPTY) -> tuple[str, int]:
        """(edits' letters, state after): the ASCII-least of the cheapest."""
        blocks = self.blocks(symbols)
        at, _ = self.solve(blocks, end)
        out = []
        for b, after in zip(blocks, at[1:], strict=True):
            letters, state = self.expand(b, after, state)
            out.append(letters)
        return "".join(out), state


def closing(state: int) -> str:
    """What is put in behind the last row."""
    return {SYSTEM: "II", USER: "I"}.get(state, "")


@cache
def tables() -> Tables:
    return Tables()
