"""Squares in a growing sequence of words, caught as words are appended.

The words read so far are cut into blocks of 2, 4, 8, ... words, at multiples of
their length. Each completed block has a catcher, which waits for the block to
come again: a square whose half has q words holds a whole block of about q / 4
to q / 2 words in its first half, and that block returns q words on. So the
catchers of blocks of L words wait at distances of 2 L - 1 to 4 L - 2 only, and
an appended word is met by two catchers a block length. A catch is extended to
both sides by comparing words; while it reaches the last word it stays open and
every appended word moves it on. Stretches that hold a square merge into runs:
the same stretch caught at several distances is one run of the least of them.

Words are appended many at a time, so that numpy does the steps of all of them;
the result does not depend on how the words are dealt into calls. Blocks are
compared by hashes (a window's from prefix sums), stretches word by word.
"""

from __future__ import annotations

import numpy as np

from relcheck.llm.shared import mix64

BASE = 0x9E3779B97F4A7C15


class Powers:
    """Powers of an odd base and of its inverse modulo 2**64, made once."""

    up = down = np.ones(1, np.uint64)

    @classmethod
    def upto(cls, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(cls.up) < n:
            size = 1 << n.bit_length()
            steps = np.full((2, size), [[BASE], [pow(BASE, -1, 1 << 64)]], np.uint64)
            steps[:, 0] = 1
            cls.up, cls.down = np.cumprod(steps, axis=1, dtype=np.uint64)
        return cls.up, cls.down


def levels(n: int):
    """(block length, least distance, greatest distance) that n words may need."""
    length, low, high = 2, 1, 6
    while 2 * low <= n:
        yield length, low, high
        length, low, high = 2 * length, high + 1, 2 * high + 2


class Catchers:
    """``append`` words as integers, equal words as equal integers; ``runs``
    gives what is known so far: runs of ``least`` words or more, 5 at least, as
    no shorter one holds a whole block of two words at every place."""

    def __init__(self, least: int = 12):
        if least < 5:
            raise ValueError("runs of fewer than 5 words are not caught")
        self.least, self.n = least, 0
        self.words, self.sums = np.zeros(0, np.int64), np.zeros(1, np.uint64)
        # by word: the end of the run found there that reaches furthest, and its period
        self.upto, self.period = np.zeros(0, np.int64), np.ones(0, np.int64)
        self.open: dict[int, int] = {}  # distance -> first word of a stretch that reaches the last word
        self.closed: dict[tuple[int, int], int] = {}  # (first word, word after) -> period

    def append(self, words: np.ndarray) -> None:
        old, self.n = self.n, self.n + len(words)
        self.words = np.concatenate([self.words, words])
        up, _ = Powers.upto(self.n + 1)
        values = mix64(words.astype(np.uint64) + np.uint64(1)) * up[old:self.n]
        self.sums = np.concatenate([self.sums, self.sums[-1] + np.cumsum(values, dtype=np.uint64)])
        self.upto = np.concatenate([self.upto, np.zeros(len(words), np.int64)])
        self.period = np.concatenate([self.period, np.ones(len(words), np.int64)])
        for q in sorted(self.open):
            self.caught(q, self.open.pop(q), self.matched_after(q, max(0, old - q)))
        for length, low, high in levels(self.n):
            self.catch(length, low, high, old)

    def catch(self, length: int, low: int, high: int, old: int) -> None:
        """The windows of this length that end among the words after ``old``,
        against the catchers that wait at these distances."""
        first = max(low, old - length + 1)
        if first > self.n - length:
            return
        ends, starts = self.sums[first + length:], self.sums[first:self.n - length + 1]
        down = Powers.down
        window = (ends - starts) * down[first:self.n - length + 1]
        oldest = max(0, first - high) // length
        at = np.arange(oldest, (self.n - length - low) // length + 1) * length
        block = (self.sums[at + length] - self.sums[at]) * down[at]
        newest = np.arange(first - low, self.n - length - low + 1) // length - oldest
        found_s, found_q = [], []
        for back in range((high - low + 1) // length):
            place = newest - back
            hit = np.flatnonzero((block.take(place, mode="clip") == window) & (place >= 0))
            if len(hit):
                s = (place[hit] + oldest) * length
                found_s.append(s)
                found_q.append(hit + first - s)
        if not found_s:
            return
        s, q = np.concatenate(found_s), np.concatenate(found_q)
        new = (self.upto[s] < s + q + length) | (q % self.period[s] != 0)  # else inside a known run
        s, q = s[new], q[new]
        order = np.lexsort((s, q))
        s, q = s[order], q[order]
        cut = np.flatnonzero((np.diff(q) != 0) | (np.diff(s) != length)) + 1
        heads, tails = s[np.concatenate([[0], cut])] if len(s) else s, s[np.concatenate([cut - 1, [-1]])] if len(s) else s
        gaps = q[np.concatenate([[0], cut])] if len(s) else q
        for head, tail, gap in zip(heads.tolist(), tails.tolist(), gaps.tolist(), strict=True):
            if self.upto[head] >= tail + gap + length and gap % self.period[head] == 0:
                continue
            left = self.matched_before(gap, head)
            right = self.matched_after(gap, left)
            if right > left:  # equal hashes of different words match nothing
                self.caught(gap, left, right)

    def matched_before(self, q: int, i: int) -> int:
        """The least l with words[l:i] equal to the words q further on."""
        step = 16
        while i:
            a = max(0, i - step)
            bad = np.flatnonzero(self.words[a:i] != self.words[a + q:i + q])
            if len(bad):
                return a + int(bad[-1]) + 1
            i, step = a, 2 * step
        return 0

    def matched_after(self, q: int, i: int) -> int:
        """The greatest r with words[i:r] equal to the words q further on."""
        step = 16
        while i + q < self.n:
            b = min(self.n - q, i + step)
            bad = np.flatnonzero(self.words[i:b] != self.words[i + q:b + q])
            if len(bad):
                return i + int(bad[0])
            i, step = b, 2 * step
        return i

    def caught(self, q: int, left: int, right: int) -> None:
        """words[left:right] equal the words q further on, and no more do."""
        end = right + q
        if end == self.n:
            self.open[q] = left
        if right - left < q:
            return
        known = self.upto[left:end]
        shorter = known < end
        known[shorter] = end
        self.period[left:end][shorter] = q
        if end < self.n and end - left >= self.least:
            self.closed[left, end] = min(q, self.closed.get((left, end), q))

    def runs(self) -> list[tuple[int, int, int]]:
        """(first word, length, period) of every run of ``least`` words or more,
        by first word, then period."""
        found = dict(self.closed)
        for q, left in self.open.items():
            if self.n - left >= max(self.least, 2 * q):
                found[left, self.n] = min(q, found.get((left, self.n), q))
        return sorted(((a, b - a, q) for (a, b), q in found.items()), key=lambda r: (r[0], r[2]))
