"""Fingerprints by shingle votes, and distances to reference fingerprints.

A reference is a fixed fingerprint. How far two fingerprints are apart is at
least the difference of their distances to any reference, so a table of such
distances discards most pairs before they are compared.
"""

from __future__ import annotations

from functools import cache

import numpy as np
import xxhash

from relcheck.llm.shared import mix64

#: ASCII capitals to small letters; other bytes stay.
LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))
SEED = 42
#: Shingles whose bits are counted at a time, so long texts need no more memory.
COUNTED = 16_384
#: References over all 64 bits, whose distances the table holds.
REFERENCES = 32
#: A block of more bits than this has random references, one of fewer a
#: reference a bit, which tell all its values apart.
FEW_BITS, BLOCK_REFERENCES = 8, 12


def fingerprint(text: bytes, words: int = 3) -> int:
    """64 bits, each 1 where over half of the shingles' hashes have it."""
    parts = text.translate(LOWER).split()
    if not parts:
        return 0
    joined, n = b" ".join(parts), min(words, len(parts))
    ends = np.cumsum(np.fromiter(map(len, parts), np.int64, len(parts)) + 1) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    total, votes = len(parts) - n + 1, np.zeros(64, np.int64)
    digest = xxhash.xxh64_intdigest
    for at in range(0, total, COUNTED):
        to = min(total, at + COUNTED)
        spans = zip(starts[at:to].tolist(), ends[at + n - 1:to + n - 1].tolist(), strict=True)
        h = np.fromiter((digest(joined[a:b], SEED) for a, b in spans), np.uint64, to - at)
        votes += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * votes > total, bitorder="little").view(np.uint64)[0])


def random_bits(n: int, salt: int) -> np.ndarray:
    """n fixed 64-bit values."""
    return mix64(np.arange(1, n + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(salt))


@cache
def references() -> np.ndarray:
    return random_bits(REFERENCES, 7)


@cache
def block_references(parts: int) -> list[np.ndarray]:
    """The 64 bits cut into ``parts`` blocks as equal as can be; the references
    of each differ from zero inside it only."""
    edges = [64 * i // parts for i in range(parts + 1)]
    out = []
    for lo, hi in zip(edges[:-1], edges[1:], strict=True):
        if hi - lo <= FEW_BITS:
            out.append(np.uint64(1) << np.arange(lo, hi, dtype=np.uint64))
        else:
            mask = np.uint64(((1 << (hi - lo)) - 1) << lo)
            out.append(random_bits(BLOCK_REFERENCES, 1000 * parts + lo) & mask)
    return out


def distances(prints: np.ndarray, refs: np.ndarray) -> np.ndarray:
    """Hamming distances, a row a fingerprint and a column a reference."""
    return np.bitwise_count(prints[:, None] ^ refs[None, :])


def cells(prints: np.ndarray, parts: int) -> np.ndarray:
    """A row of cells a fingerprint: for every two blocks the name of its
    distances (less that to zero) to the references of all other blocks. Two
    fingerprints that differ in two bits agree outside some two blocks, where
    their distances are the same, so they share a cell."""
    zero = np.bitwise_count(prints).astype(np.int64)[:, None]
    codes = np.empty((len(prints), parts), np.uint64)
    for i, refs in enumerate(block_references(parts)):
        code = np.full(len(prints), i + 1, np.uint64)
        for column in (distances(prints, refs) - zero).T:
            code = mix64(code * np.uint64(131) + column.astype(np.int64).view(np.uint64))
        codes[:, i] = code
    total = codes.sum(axis=1, dtype=np.uint64)
    pairs = [(i, j) for i in range(parts) for j in range(i + 1, parts)]
    out = np.empty((len(prints), len(pairs)), np.uint64)
    for k, (i, j) in enumerate(pairs):
        out[:, k] = mix64(total - codes[:, i] - codes[:, j] + np.uint64(64 * parts + k))
    return out.view(np.int64)


def near_pairs(prints: np.ndarray, table: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
    """Places (i, j), i < j, of fingerprints at most ``most`` bits apart: pairs
    whose distances to some reference differ by more are discarded, the others
    compared. ``table``: their distances to ``references()``."""
    i, j = np.triu_indices(len(prints), 1)
    for column in table.T.astype(np.int16):
        alike = np.abs(column[i] - column[j]) <= most
        i, j = i[alike], j[alike]
        if not len(i):
            return i, j
    close = np.bitwise_count(prints[i] ^ prints[j]) <= most
    return i[close], j[close]
