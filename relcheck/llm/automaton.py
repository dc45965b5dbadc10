"""A generalised suffix automaton over item words, and its use on documents."""

from __future__ import annotations

import numpy as np


class Automaton:
    """All runs of words of a block of items. ``n``: words of a window; an item
    of fewer words is one window itself. Memory follows the block's words."""

    def __init__(self, items: list[tuple[str, list[bytes]]], n: int):
        """``items``: (item id, words); pieces of one item may share its id.
        A piece marked short must be a whole item."""
        self.n = n
        self.words: dict[bytes, int] = {}
        self.step: list[dict[int, int]] = [{}]
        self.link, self.size = [-1], [0]
        coded = [(name, [self.words.setdefault(w, len(self.words)) for w in ws]) for name, ws in items if ws]
        for _, ids in coded:
            last = 0
            for w in ids:
                last = self._extend(last, w)
        # windows: (state that holds it, length) -> items
        self.owners: dict[tuple[int, int], set[str]] = {}
        for name, ids in coded:
            k = min(n, len(ids))
            state, length = 0, 0
            for w in ids:
                state, length = self.advance(state, length, w)
                if length >= k:
                    at = state
                    while self.link[at] >= 0 and self.size[self.link[at]] >= k:
                        at = self.link[at]
                    self.owners.setdefault((at, k), set()).add(name)
        self.least = min((k for _, k in self.owners), default=0)
        # for every state: windows that end there, as (length, items), by growing length
        held: dict[int, list[tuple[int, set[str]]]] = {}
        for (at, k), names in self.owners.items():
            held.setdefault(at, []).append((k, names))
        self.ends: list[list[tuple[int, set[str]]]] = [[] for _ in self.size]
        for s in sorted(range(1, len(self.size)), key=self.size.__getitem__):
            self.ends[s] = self.ends[self.link[s]] + sorted(held.get(s, []), key=lambda x: x[0])

    def _extend(self, last: int, w: int) -> int:
        step, link, size = self.step, self.link, self.size
        if w in step[last]:
            q = step[last][w]
            return q if size[q] == size[last] + 1 else self._clone(last, w, q)
        new = len(size)
        step.append({})
        size.append(size[last] + 1)
        link.append(0)
        p = last
        while p >= 0 and w not in step[p]:
            step[p][w] = new
            p = link[p]
        if p >= 0:
            q = step[p][w]
            link[new] = q if size[q] == size[p] + 1 else self._clone(p, w, q)
        return new

    def _clone(self, p: int, w: int, q: int) -> int:
        new = len(self.size)
        self.step.append(dict(self.step[q]))
        self.size.append(self.size[p] + 1)
        self.link.append(self.link[q])
        self.link[q] = new
        while p >= 0 and self.step[p].get(w) == q:
            self.step[p][w] = new
            p = self.link[p]
        return new

    def advance(self, state: int, length: int, w: int) -> tuple[int, int]:
        """The longest run of words ending here that an item has."""
        step = self.step
        while w not in step[state]:
            state = self.link[state]
            if state < 0:
                return 0, 0
            length = self.size[state]
        return step[state][w], length + 1

    def scan(self, words: list[bytes]) -> tuple[list[tuple[int, int]], set[str], int]:
        """(spans of hit words, items with a window here, longest match)."""
        get = self.words.get
        ids = np.fromiter([get(w, -1) for w in words], np.int32, len(words))
        known = np.concatenate([[False], ids >= 0, [False]])
        edges = np.flatnonzero(known[1:] != known[:-1])
        spans: list[tuple[int, int]] = []
        found: set[str] = set()
        longest = 0
        for a, b in zip(edges[::2].tolist(), edges[1::2].tolist(), strict=True):
            longest = max(longest, self._stretch(ids[a:b].tolist(), a, spans, found)) if b - a >= self.least else longest
        return spans, found, longest

    def _stretch(self, ids: list[int], at: int, spans: list[tuple[int, int]], found: set[str]) -> int:
        """Stream one stretch of known words through the automaton."""
        state = length = longest = 0
        step, link, size, ends, least = self.step, self.link, self.size, self.ends, self.least
        for i, w in enumerate(ids, at + 1):
            nxt = step[state].get(w)
            while nxt is None and state:
                state = link[state]
                length = size[state]
                nxt = step[state].get(w)
            if nxt is None:
                continue
            state, length = nxt, length + 1
            if length < least:
                continue
            longest = max(longest, length)
            best = 0
            for k, names in ends[state]:
                if k > length:
                    break
                best = k
                found |= names
            if best:
                if spans and spans[-1][1] >= i - best:
                    spans[-1] = (min(spans[-1][0], i - best), i)
                    while len(spans) > 1 and spans[-2][1] >= spans[-1][0]:
                        low = spans.pop()
                        spans[-1] = (min(spans[-1][0], low[0]), max(spans[-1][1], low[1]))
                else:
                    spans.append((i - best, i))
        return longest
