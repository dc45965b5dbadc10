"""A linear-chain conditional random field over word shapes, in numpy.

Features of a word: its shape, the shapes of its neighbours, and a coarse
shape each, so shapes never seen in training still carry evidence. Trained by
gradient ascent on the exact log-likelihood (forward-backward), decoded by
Viterbi over batches of lines.
"""

from __future__ import annotations

import re

import numpy as np

LABELS = ("O", "B-email", "B-ip", "B-card", "I-card", "B-phone", "I-phone")
MARK = re.compile(r"\[(email|ip|card|phone):([^\]]+)\]")

#: The small labelled table. Marked spans are personal data of the
#: kind named, all else is not.
LABELLED = (
    "Call me at [phone:+1 (212) 555-0134] after nine.",
    "My number is [phone:+44 20 7946 0958] in London.",
    "Ring [phone:(415) 555-0199] or write to [email:jane.doe@example.com] today.",
    "Phone [phone:(030) 555-7713] before noon.",
    "Reach us on [phone:555-867-5309] any day.",
    "His mobile is [phone:212-555-0147] he said.",
    "the old line [phone:(201) 555-0155] is off",
    "dial [phone:+1 (361) 555-8283] for help",
    "fax [phone:+49 30 901820] at the desk",
    "Please mail [email:a.smith@mail.example.org] soon.",
    "Send it to [email:bob_77@corp.example.net] now.",
    "the address [email:info@shop.example.co.uk] works",
    "write [email:the.34@mail7.example.com] instead",
    "contact [email:x.y+z@dept.example.edu] please",
    "The server at [ip:192.168.10.4] is down.",
    "ping [ip:10.0.0.1] and [ip:172.16.254.3] first",
    "host [ip:129.38.82.176] answered in time",
    "from [ip:8.8.4.4] to the core",
    "Pay with [card:4111 1111 1111 1111] at the till.",
    "card [card:4929348385146306] was charged",
    "number [card:5500-0000-0000-0004] expired",
    "use [card:4012 8888 8888 1881] instead",
    "the card [card:4417744280351547] is lost",
    "In 1999 the town had 12,345 people and 3 mills.",
    "Version 2.0 came out in 2011.",
    "Version 1.10.3 fixes issue 4521.",
    "It cost 45.50 and took 3.5 hours.",
    "See pages 12-15 and 102-110 of volume 7.",
    "On 2021-03-04 at 10:30 they met.",
    "The score was 3-2 in 90 minutes.",
    "order 66 of 1977 was void",
    "token = \"269b17fe003c9a0b3c6a43eb78aa99cbd7049c57\" was found",
    "serial 9f86d081884c7d65 and 00f9a3 differ",
    "id 5366837 and 982431 were merged",
    "There are 1000000 rows in 24 files.",
    "the ratio 16:9 and 100% are fine",
    "room 101, floor 3, desk 12",
    "between 1914 and 1918 (4 years)",
    "call 911 if you must",
    "a list: 1. one 2. two 3. three",
    "the the of and a to in is was for",
    "Plain words have no data in them at all.",
    "MIT License and Apache License, Version 2.0.",
    "Licensed under CC BY-NC 4.0.",
    "### word$$$ other%%% thing*** more&&&",
    "one | two | three | four | five",
    "he said: \"no\" (twice); they left.",
    "la maison et le chat, de la rue",
    "el perro y la casa, en el monte",
    "der Hund und die Katze, im Haus",
    "x = y + 1 and z - 2 over 3",
    "+ 1 and + 22 are sums",
    "5 + 7 = 12 and 3 + 4 = 7",
    "twenty @ five each",
    "@someone said #hello in 2020",
    "12 345 678 people",
    "code 9807915762804490123456 is no card",
    "90 210 45 12 7 3 11 were drawn",
)


#: Digits become d, capitals X, small letters and bytes of other scripts x.
PATTERN = bytes(100 if 48 <= b <= 57 else 88 if 65 <= b <= 90 else 120 if 97 <= b <= 122 or b >= 128 else b for b in range(256))
SQUEEZE = re.compile(rb"([^d])\1+|(d{5})d+")


def shape(pattern: bytes) -> str:
    """The pattern squeezed: runs count as one, those of digits up to five."""
    short = SQUEEZE.sub(rb"\1\2", pattern[:64])
    return short.decode("ascii") + ("~" if len(pattern) > 64 else "")


def coarse(pattern: bytes) -> str:
    """What kinds of bytes a word has, and how many digits."""
    digits = pattern.count(b"d")
    n = 0 if not digits else 1 if digits < 3 else 2 if digits < 5 else 3 if digits < 8 else 4 if digits < 13 else 5 if digits < 20 else 6
    marks = "".join(m for m, yes in (("a", b"x" in pattern or b"X" in pattern), ("@", b"@" in pattern), (".", pattern.count(b".") >= 3),
                                     ("(", b"(" in pattern), ("-", b"-" in pattern), ("+", pattern[:1] == b"+")) if yes)
    return f"{n}{marks}"


def features(pattern: bytes | None) -> list[str]:
    return ["", "~"] if pattern is None else [shape(pattern), "~" + coarse(pattern)]


class Crf:
    """weights: feature name -> row of scores; trans, start: label scores."""

    def __init__(self, names: dict[str, int], weights: np.ndarray, trans: np.ndarray, start: np.ndarray):
        self.names, self.weights, self.trans, self.start = names, weights, trans, start

    def rows(self, pattern: bytes | None) -> np.ndarray:
        """Scores of a word as (own, left neighbour's, right neighbour's)."""
        out = np.zeros((3, len(LABELS)), np.float32)
        for where, tag in enumerate("=<>"):
            for f in features(pattern):
                i = self.names.get(tag + f)
                if i is not None:
                    out[where] += self.weights[i]
        return out


def parse(line: str) -> tuple[list[bytes], list[int]]:
    """Word patterns and label numbers of one marked line."""
    words, labels, at = [], [], 0
    for m in [*MARK.finditer(line), None]:
        for w in line[at:m.start() if m else None].split():
            words.append(w.encode().translate(PATTERN))
            labels.append(0)
        if m:
            for i, w in enumerate(m[2].split()):
                words.append(w.encode().translate(PATTERN))
                labels.append(LABELS.index(("B-" if i == 0 or m[1] in ("email", "ip") else "I-") + m[1]))
            at = m.end()
    return words, labels


def lse(x: np.ndarray, axis: int) -> np.ndarray:
    top = x.max(axis=axis, keepdims=True)
    return (top + np.log(np.exp(x - top).sum(axis=axis, keepdims=True))).squeeze(axis)


def train(labelled: tuple[str, ...] = LABELLED, steps: int = 120, rate: float = 0.3, decay: float = 0.01) -> Crf:
    """Adagrad on the penalised log-likelihood; the same table gives the same
    model. Memory and time follow the labelled table, which is small."""
    data = [parse(x) for x in labelled if x and x.strip()]
    names: dict[str, int] = {}
    lines = []
    for words, labels in data:
        own = []
        for i in range(len(words)):
            left, right = words[i - 1] if i else None, words[i + 1] if i + 1 < len(words) else None
            own.append([names.setdefault(tag + f, len(names)) for tag, w in (("=", words[i]), ("<", left), (">", right)) for f in features(w)])
        lines.append((np.array(own), np.array(labels)))
    k = len(LABELS)
    w, trans, start = np.zeros((len(names), k)), np.zeros((k, k)), np.zeros(k)
    for b in range(k):  # an inside label follows its own kind alone
        if LABELS[b].startswith("I-"):
            trans[[a for a in range(k) if LABELS[a][2:] != LABELS[b][2:]], b] = -30.0
            start[b] = -30.0
    open_t, open_s = trans == 0, start == 0
    held = [np.full_like(x, 1e-6) for x in (w, trans, start)]
    for _ in range(steps):
        g = [-decay * w, -decay * trans, -decay * start]
        for f, y in lines:
            e = w[f].sum(axis=1)
            n = len(y)
            alpha, beta = np.zeros((n, k)), np.zeros((n, k))
            alpha[0] = start + e[0]
            for t in range(1, n):
                alpha[t] = lse(alpha[t - 1][:, None] + trans, 0) + e[t]
            for t in range(n - 2, -1, -1):
                beta[t] = lse(trans + (e[t + 1] + beta[t + 1])[None, :], 1)
            z = lse(alpha[-1], 0)
            p = np.exp(alpha + beta - z)
            diff = -p
            diff[np.arange(n), y] += 1
            for c in range(f.shape[1]):
                np.add.at(g[0], f[:, c], diff)
            g[2] += diff[0]
            for t in range(1, n):
                g[1] -= np.exp(alpha[t - 1][:, None] + trans + (e[t] + beta[t])[None, :] - z)
                g[1][y[t - 1], y[t]] += 1
        for x, d, h, free in ((w, g[0], held[0], True), (trans, g[1], held[1], open_t), (start, g[2], held[2], open_s)):
            h += d * d
            x += np.where(free, rate * d / np.sqrt(h), 0)
    return Crf(names, w.astype(np.float32), trans.astype(np.float32), start.astype(np.float32))


class Classes(dict):
    """Word -> class of its features, filled on first sight; bounded. Words
    share few patterns, which have a table of their own, bounded too."""

    MOST = 250_000

    def __init__(self, decoder: Decoder):
        self.decoder, self.patterns = decoder, {}

    def __missing__(self, word: bytes) -> int:
        pattern = word.translate(PATTERN)
        c = self.patterns.get(pattern)
        if c is None:
            c = self.decoder.class_of(pattern)
            if len(word) <= 64:
                if len(self.patterns) >= self.MOST:
                    self.patterns.clear()
                self.patterns[pattern] = c
        if len(word) <= 64:
            if len(self) >= self.MOST:
                self.clear()
            self[word] = c
        return c


class Decoder:
    """Viterbi over many lines at once. Every distinct set of word features is
    scored once. ``loud`` tells the lines that need no decoding, by a bound:
    leaving label O over some words changes at most two transitions a word, so
    where every word's best other label is worse than O by more than two
    transitions can give back, the best path is O throughout."""

    def __init__(self, crf: Crf):
        self.crf, self.classes, self.words = crf, {}, Classes(self)
        self.tables: list[np.ndarray] = [crf.rows(None)]  # class 0: no word
        self.table = None
        t, s = crf.trans, crf.start
        self.give = 2 * float(max(t.max() - t[0, 0], s.max() - s[0], 0))

    def class_of(self, pattern: bytes) -> int:
        # a feature that the model has no weight for scores nothing: one class for all such
        f = tuple(x if any(t + x in self.crf.names for t in "=<>") else None for x in features(pattern))
        c = self.classes.get(f)
        if c is None:
            c = self.classes[f] = len(self.tables)
            self.tables.append(self.crf.rows(pattern))
            self.table = None
        return c

    def ids(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.words.__getitem__, words), np.int32, len(words))

    def _settle(self) -> None:
        if self.table is None:
            self.table = np.stack(self.tables)
            self.margin = self.table[:, :, 0] - self.table[:, :, 1:].max(axis=2)

    def loud(self, ids: np.ndarray) -> np.ndarray:
        """Words that may take part in a span, whichever words end lines."""
        self._settle()
        own, left, right = self.margin[:, 0], self.margin[:, 1], self.margin[:, 2]
        left, right = np.minimum(left, left[0]), np.minimum(right, right[0])
        m = own[ids]
        if len(ids):
            m[1:] += left[ids[:-1]]
            m[0] += left[0]
            m[:-1] += right[ids[1:]]
            m[-1] += right[0]
        return m <= self.give

    def decode(self, ids: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Labels of all words; ``ends``: where each line ends in ``ids``."""
        self._settle()
        own, left, right = self.table[:, 0], self.table[:, 1], self.table[:, 2]
        starts = np.concatenate([[0], ends[:-1]])
        some = ends > starts
        starts, ends = starts[some], ends[some]
        labels = np.zeros(len(ids), np.int8)
        if not len(starts):
            return labels
        prev = np.concatenate([[0], ids[:-1]])
        prev[starts] = 0
        follow = np.concatenate([ids[1:], [0]])
        follow[ends - 1] = 0
        length = ends - starts
        order = np.argsort(-length, kind="stable")
        starts, length = starts[order], length[order]
        score, k = None, len(LABELS)
        back = np.zeros(len(ids), np.int64)  # best label before, four bits a label
        shifts = (4 * np.arange(k)).astype(np.int64)
        final = np.zeros(len(starts), np.int8)
        alive = np.searchsorted(-length, -np.arange(length[0] + 1), side="left")  # lines longer than t
        trans = self.crf.trans
        for t in range(int(length[0])):
            n = int(alive[t])
            at = starts[:n] + t
            e = own[ids[at]] + left[prev[at]] + right[follow[at]]
            if t == 0:
                score = e + self.crf.start
            else:
                best, arg = score[:n, 0, None] + trans[0], np.zeros((n, k), np.int64)
                for a in range(1, k):
                    other = score[:n, a, None] + trans[a]
                    up = other > best
                    np.copyto(best, other, where=up)
                    arg[up] = a
                back[at] = (arg << shifts).sum(axis=1)
                score[:n] = best + e
            done = int(alive[t + 1]) if t + 1 < len(alive) else 0
            final[done:n] = score[done:n].argmax(axis=1)
        # walk back from the last word of every line
        now = final.astype(np.int64)
        for t in range(int(length[0]) - 1, -1, -1):
            n = int(alive[t])
            at = starts[:n] + t
            labels[at] = now[:n]
            if t:
                now[:n] = (back[at] >> (4 * now[:n])) & 15
        return labels
