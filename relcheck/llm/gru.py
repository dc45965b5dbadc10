"""A bidirectional gated recurrent network with attention pooling, in numpy.

A word's input joins a vector of the word (hashed) and the mean of vectors of
its character three- and four-grams (hashed); its part of the gates is computed once a
word and kept. A window's states are pooled by attention and scored by a
logistic unit. Trained by Adam on whole windows; all arithmetic in float32.
"""

from __future__ import annotations

import numpy as np

from relcheck.llm.shared import mix64

WORD_ROWS, GRAM_ROWS, WIDTH, HIDDEN = 1 << 15, 1 << 14, 8, 8
WINDOW, STRIDE = 64, 32
#: Letters and digits in small letters; other ASCII becomes a space.
FOLD = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))
MOST_WORDS, WORD_BYTES = 150_000, 48


def sigmoid(x: np.ndarray) -> np.ndarray:
    np.clip(x, -30, 30, out=x)
    np.negative(x, out=x)
    np.exp(x, out=x)
    x += 1
    return np.reciprocal(x, out=x)


def tanh(x: np.ndarray) -> np.ndarray:
    return 2 * sigmoid(2 * x) - 1


def rows_of(words: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For every word: the row of its own vector, and the rows of its three-
    and four-grams, framed by < and >, as one list and where each word's start."""
    size = np.fromiter(map(len, words), np.int64, len(words)) + 2
    text = np.frombuffer(b"<" + b"><".join(words) + b">\0\0\0", np.uint8).astype(np.uint64)
    first = np.concatenate([[0], np.cumsum(size)[:-1]])
    n = int(size.sum())
    place = np.arange(n) - np.repeat(first, size)
    whole = np.add.reduceat(mix64((text[:n] + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15) + place.astype(np.uint64) * np.uint64(0xC2B2AE3D27D4EB4F)), first)
    three = (text[:n] * np.uint64(65536) + text[1:n + 1] * np.uint64(256) + text[2:n + 2])
    four = three * np.uint64(256) + text[3:n + 3]
    left = np.repeat(size, size) - place  # bytes from here to the word's end
    grams = np.stack([mix64(three) % np.uint64(GRAM_ROWS), mix64(four + np.uint64(1 << 40)) % np.uint64(GRAM_ROWS)], axis=1)
    valid = np.stack([left >= 3, left >= 4], axis=1)
    valid[first, 0] = True  # a word has one gram at least
    counts = np.add.reduceat(valid.sum(axis=1), first)
    return (mix64(whole) % np.uint64(WORD_ROWS)).astype(np.int64), grams[valid].astype(np.int64), np.concatenate([[0], np.cumsum(counts)])


class Model(dict):
    """Parameters by name."""

    @staticmethod
    def fresh(seed: int = 7) -> Model:
        r = np.random.default_rng(seed)
        f = lambda *s, by=1.0: (r.standard_normal(s) * by).astype(np.float32)
        m = Model(words=f(WORD_ROWS, WIDTH, by=0.02), grams=f(GRAM_ROWS, WIDTH, by=0.1), a=f(2 * HIDDEN, by=0.3),
                  o=f(2 * HIDDEN, by=0.3), o0=np.zeros(1, np.float32))
        for d in "fb":
            m["W" + d], m["U" + d] = f(2 * WIDTH, 3 * HIDDEN, by=0.3), f(HIDDEN, 3 * HIDDEN, by=0.3)
            m["c" + d] = np.zeros(3 * HIDDEN, np.float32)
        return m


def steps(p: np.ndarray, mask: np.ndarray, u: np.ndarray, back: bool, keep: list | None = None) -> np.ndarray:
    """States [T, B, H] of one direction. p: input part of the gates [T, B, 3H];
    padded words leave the state as it is."""
    t_all, n = mask.shape
    h, out = np.zeros((n, HIDDEN), np.float32), np.empty((t_all, n, HIDDEN), np.float32)
    for t in range(t_all - 1, -1, -1) if back else range(t_all):
        g = h @ u
        zr = sigmoid(p[t, :, :2 * HIDDEN] + g[:, :2 * HIDDEN])
        z, r = zr[:, :HIDDEN], zr[:, HIDDEN:]
        gc = g[:, 2 * HIDDEN:]
        c = tanh(p[t, :, 2 * HIDDEN:] + r * gc)
        z = z * mask[t][:, None]
        new = h + z * (c - h)
        if keep is not None:
            keep.append((t, h, z, zr, gc, c))
        h = new
        out[t] = h
    return out


def pool(m: Model, hf: np.ndarray, hb: np.ndarray, mask: np.ndarray):
    """(probability, attention [T, B], pooled [B, 2H], states)."""
    states = np.concatenate([hf, hb], axis=2)
    e = np.where(mask > 0, states @ m["a"], np.float32(-1e9))
    e -= e.max(axis=0)
    w = np.exp(e) * mask
    w /= np.maximum(w.sum(axis=0), 1e-9)
    pooled = np.einsum("tb,tbh->bh", w, states)
    return sigmoid(pooled @ m["o"] + m["o0"]), w, pooled, states


HALF = np.concatenate([np.full(2 * HIDDEN, 0.5), np.ones(HIDDEN)]).astype(np.float32)


def fast_steps(table: np.ndarray, ids: np.ndarray, mask: np.ndarray, u: np.ndarray, back: bool) -> np.ndarray:
    """``steps`` for scoring, states as [T, H, B]: gates of a step by feature,
    sigmoids as halved tanh (table and u hold halved z and r parts)."""
    t_all, n = mask.shape
    h, out = np.zeros((HIDDEN, n), np.float32), np.empty((t_all, HIDDEN, n), np.float32)
    g, p = np.empty((3 * HIDDEN, n), np.float32), np.empty((3 * HIDDEN, n), np.float32)
    zr, c = np.empty((2 * HIDDEN, n), np.float32), np.empty((HIDDEN, n), np.float32)
    for t in range(t_all - 1, -1, -1) if back else range(t_all):
        np.copyto(p, table[ids[t]].T)
        np.matmul(u, h, out=g)
        np.add(p[:2 * HIDDEN], g[:2 * HIDDEN], out=zr)
        np.tanh(zr, out=zr)
        zr *= 0.5
        zr += 0.5
        np.multiply(zr[HIDDEN:], g[2 * HIDDEN:], out=c)
        c += p[2 * HIDDEN:]
        np.tanh(c, out=c)
        c -= h
        c *= zr[:HIDDEN]
        c *= mask[t]
        h = np.add(h, c, out=out[t])
    return out


class Inputs(dict):
    """word -> number; the words' gate inputs for a fixed model, bounded."""

    def __init__(self, m: Model):
        self.m, self.count = m, 0
        self.of_f = np.zeros((MOST_WORDS + 2, 3 * HIDDEN), np.float32)
        self.of_b = np.zeros_like(self.of_f)
        self.fresh: list[bytes] = []

    def __missing__(self, word: bytes) -> int:
        self.count += 1
        self[word] = self.count
        self.fresh.append(word)
        return self.count

    def ids(self, words: list[bytes]) -> np.ndarray:
        """Numbers of the words, all with their rows computed."""
        if self.count + len(words) > MOST_WORDS:  # may not fit: start over
            if len(set(words)) > MOST_WORDS - self.count:
                self.clear()
                self.count = 0
        ids = np.fromiter(map(self.__getitem__, words), np.int32, len(words))
        if self.fresh:
            x = vectors(self.m, self.fresh)
            at = slice(self.count - len(self.fresh) + 1, self.count + 1)
            self.of_f[at] = (x @ self.m["Wf"] + self.m["cf"]) * HALF
            self.of_b[at] = (x @ self.m["Wb"] + self.m["cb"]) * HALF
            self.fresh = []
        return ids


def vectors(m: Model, words: list[bytes]) -> np.ndarray:
    """[n, 2 WIDTH]: the word's vector and the mean of its grams'."""
    own, grams, at = rows_of(words)
    mean = np.add.reduceat(m["grams"][grams], at[:-1], axis=0) / np.diff(at)[:, None].astype(np.float32)
    return np.concatenate([m["words"][own], mean], axis=1)


def window_starts(n: int) -> np.ndarray:
    """Overlapping windows over n words; every word is in one at least."""
    return STRIDE * np.arange(1 + max(0, -(-(n - WINDOW) // STRIDE)))


class Scorer:
    """Probabilities of all windows of many texts."""

    BATCH = 1024

    def __init__(self, m: Model):
        self.m, self.inputs = m, Inputs(m)
        self.u = {d: np.ascontiguousarray((m["U" + d] * HALF).T) for d in "fb"}

    def windows(self, ids: np.ndarray) -> np.ndarray:
        """One score a window; ``ids`` [B, T] of word numbers, 0 is no word."""
        out = np.empty(len(ids), np.float32)
        for at in range(0, len(ids), self.BATCH):
            x = np.ascontiguousarray(ids[at:at + self.BATCH].T)
            mask = (x > 0).astype(np.float32)
            hf = fast_steps(self.inputs.of_f, x, mask, self.u["f"], False)
            hb = fast_steps(self.inputs.of_b, x, mask, self.u["b"], True)
            a, o = self.m["a"], self.m["o"]
            e = np.einsum("h,thb->tb", a[:HIDDEN], hf, optimize=True) + np.einsum("h,thb->tb", a[HIDDEN:], hb, optimize=True)
            e = np.where(mask > 0, e, np.float32(-1e9))
            w = np.exp(e - e.max(axis=0)) * mask
            w /= np.maximum(w.sum(axis=0), 1e-9)
            v = np.einsum("h,thb->tb", o[:HIDDEN], hf, optimize=True) + np.einsum("h,thb->tb", o[HIDDEN:], hb, optimize=True)
            out[at:at + self.BATCH] = sigmoid((w * v).sum(axis=0) + self.m["o0"])
        return out

    def texts(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """(score, number of the window that gave it) of every text: the
        highest window. A text without words has one window without words."""
        scores, places = np.zeros(len(texts), np.float32), np.zeros(len(texts), np.int64)
        words: list[bytes] = []
        starts, of, size = [], [], 0
        group: list[list[bytes]] = []

        def flush() -> None:
            nonlocal words, starts, of
            if not of:
                return
            ids = np.concatenate([self.inputs.ids(words), np.zeros(WINDOW, np.int32)])
            grid = ids[np.concatenate([s for s, _ in starts])[:, None] + np.arange(WINDOW)]
            ends = np.concatenate([np.full(len(s), e) for s, e in starts])
            grid[(np.concatenate([s for s, _ in starts])[:, None] + np.arange(WINDOW)) >= ends[:, None]] = 0
            p = self.windows(grid)
            first = np.concatenate([[0], np.cumsum([len(s) for s, _ in starts])])
            for i, a, b in zip(of, first, first[1:], strict=False):
                k = int(p[a:b].argmax())
                if p[a + k] > scores[i]:
                    scores[i], places[i] = p[a + k], k + places_before.get(i, 0)
                places_before[i] = places_before.get(i, 0) + b - a
            words, starts, of = [], [], []

        places_before: dict[int, int] = {}
        for i, t in enumerate(texts):
            ws = t.translate(FOLD).split()
            s = window_starts(len(ws))
            # a long text goes in parts of whole windows, so memory is bounded
            per = 2048
            for a in range(0, len(s), per):
                part = s[a:a + per]
                lo, hi = int(part[0]), min(len(ws), int(part[-1]) + WINDOW)
                if len(words) + hi - lo > 140_000:
                    flush()
                starts.append((part - lo + len(words), len(words) + hi - lo))
                of.append(i)
                words += ws[lo:hi]
        flush()
        return scores, places


def gradients(m: Model, words: list[list[bytes]], y: np.ndarray, weight: np.ndarray) -> tuple[dict[str, np.ndarray], np.ndarray]:
    """Gradients of the weighted log-loss over windows, and probabilities."""
    flat = sorted({w for ws in words for w in ws})
    number = {w: i + 1 for i, w in enumerate(flat)}
    v = np.concatenate([np.zeros((1, 2 * WIDTH), np.float32), vectors(m, flat) if flat else np.zeros((0, 2 * WIDTH), np.float32)])
    t_all = max(1, max(map(len, words)))
    ids = np.zeros((t_all, len(words)), np.int64)
    for b, ws in enumerate(words):
        ids[:len(ws), b] = [number[w] for w in ws]
    mask = (ids > 0).astype(np.float32)
    x = v[ids]
    keep = {"f": [], "b": []}
    states = {d: steps(x @ m["W" + d] + m["c" + d], mask, m["U" + d], d == "b", keep[d]) for d in "fb"}
    p, w, pooled, h = pool(m, states["f"], states["b"], mask)
    d_out = (p - y) * weight
    g = {"o": pooled.T @ d_out, "o0": np.array([d_out.sum()], np.float32)}
    d_pool = d_out[:, None] * m["o"]
    d_w = np.einsum("bh,tbh->tb", d_pool, h)
    d_e = w * (d_w - (w * d_w).sum(axis=0))
    g["a"] = np.einsum("tb,tbh->h", d_e, h)
    d_h = w[:, :, None] * d_pool + d_e[:, :, None] * m["a"]
    d_x = np.zeros_like(x)
    for k, d in enumerate("fb"):
        into = d_h[:, :, k * HIDDEN:(k + 1) * HIDDEN]
        u, carry = m["U" + d], np.zeros((len(words), HIDDEN), np.float32)
        d_u, d_p = np.zeros_like(u), np.zeros((t_all, len(words), 3 * HIDDEN), np.float32)
        for t, h0, z, zr, gc, c in reversed(keep[d]):
            dh = into[t] + carry
            r = zr[:, HIDDEN:]
            dc = dh * z * (1 - c * c)
            dz = dh * (c - h0) * mask[t][:, None] * zr[:, :HIDDEN] * (1 - zr[:, :HIDDEN])
            dr = dc * gc * r * (1 - r)
            d_p[t] = np.concatenate([dz, dr, dc], axis=1)
            dg = np.concatenate([dz, dr, dc * r], axis=1)
            d_u += h0.T @ dg
            carry = dh * (1 - z) + dg @ u.T
        g["U" + d], g["c" + d] = d_u, d_p.sum(axis=(0, 1))
        g["W" + d] = np.einsum("tbi,tbj->ij", x, d_p, optimize=True)
        d_x += d_p @ m["W" + d].T
    by_word = np.zeros_like(v)
    np.add.at(by_word, ids.ravel(), d_x.reshape(-1, 2 * WIDTH))
    g["words"], g["grams"] = np.zeros_like(m["words"]), np.zeros_like(m["grams"])
    if flat:
        own, grams, at = rows_of(flat)
        np.add.at(g["words"], own, by_word[1:, :WIDTH])
        np.add.at(g["grams"], grams, np.repeat(by_word[1:, WIDTH:] / np.diff(at)[:, None].astype(np.float32), np.diff(at), axis=0))
    return g, p


#: Share of words left out of a training window, by chance: no example is
#: learnt by heart.
DROPPED = 0.15


class Adam:
    def __init__(self, m: Model, rate: float):
        self.m, self.rate, self.t = m, rate, 0
        self.held = {k: (np.zeros_like(x), np.zeros_like(x)) for k, x in m.items()}

    def step(self, g: dict[str, np.ndarray]) -> None:
        self.t += 1
        for k, d in g.items():
            a, b = self.held[k]
            a += 0.1 * (d - a)
            b += 0.001 * (d * d - b)
            self.m[k] -= (self.rate * (a / (1 - 0.9 ** self.t)) / (np.sqrt(b / (1 - 0.999 ** self.t)) + 1e-6)).astype(np.float32)


def train(texts: list[bytes], labels: list[int], rounds: int = 8, batches: int = 60, size: int = 64, rate: float = 0.01, seed: int = 11) -> Model:
    """Multiple-instance training: a document is as toxic as its worst window.
    Each round scores every window; a toxic document's best window (all of them
    in the first round) is an example of 1, a clean one's best and one by chance are
    examples of 0. Fixed seed: the same rows give the same model."""
    r = np.random.default_rng(seed)
    m = Model.fresh()
    split = [t.translate(FOLD).split() for t in texts]
    y = np.array(labels)
    if not len(y) or y.min() == y.max():  # one class alone says nothing: a constant
        m["o"][:] = 0
        m["o0"][:] = 0 if not len(y) else (4 if y.max() else -4)
        return m
    adam = Adam(m, rate)
    window = lambda i, k: split[i][k * STRIDE:k * STRIDE + WINDOW]
    yes, no = np.flatnonzero(y == 1), np.flatnonzero(y == 0)
    top = None
    for turn in range(rounds):
        adam.rate = rate if turn < rounds - 3 else rate / 4
        if turn:
            top = Scorer(m).texts(texts)[1]
        for _ in range(batches):
            pick = np.concatenate([r.choice(yes, size // 2), r.choice(no, size // 2)])
            words = []
            for j, i in enumerate(pick):
                n = len(window_starts(len(split[i])))
                best = top is not None and (y[i] == 1 or j % 2)
                ws = window(i, int(top[i]) if best else int(r.integers(n)))
                words.append([w for w, stays in zip(ws, r.random(len(ws)) > DROPPED, strict=True) if stays])
            g, _ = gradients(m, words, y[pick].astype(np.float32), np.full(size, 1 / size, np.float32))
            adam.step(g)
    return m
