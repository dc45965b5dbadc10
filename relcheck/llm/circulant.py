"""Circulant MinHash in numpy: signatures, bands and whole shingle sets."""

from __future__ import annotations

import numpy as np
import xxhash

from relcheck.llm.shared import WordHashes, mix64, shingle_hashes

#: ASCII capitals to small letters; other bytes stay.
LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))
#: 48 bands of 5 coordinates: a pair of similarity 0.75 meets in no band with
#: probability (1 - 0.75**5) ** 48 = 2e-6, one of 0.3 in any with 0.11.
BANDS, ROWS = 48, 5
#: Step between the circular shifts, odd, so that all shifts differ.
STEP = 0x9E3779B1


def word_set(text: bytes, hashes: WordHashes, n: int = 5) -> np.ndarray:
    """Sorted distinct hashes of the text's n-word shingles."""
    return np.unique(shingle_hashes(hashes.of(text.translate(LOWER).split()), n))


def signature(shingles: np.ndarray, k: int = BANDS * ROWS, block: int = 16_384) -> np.ndarray:
    """k coordinates from two permutations of the integers below 2**32. The
    first permutation spreads the shingles once; coordinate j is the least
    value that the second, shifted circularly by j steps, gives any of them.
    Worked in blocks, so long documents need no more memory."""
    first = (mix64(shingles ^ np.uint64(0x5851F42D4C957F2D)) >> np.uint64(32)).astype(np.uint32)
    shifts = (np.arange(k, dtype=np.uint64) * np.uint64(STEP)).astype(np.uint32)
    out = np.full(k, 0xFFFFFFFF, np.uint32)
    for at in range(0, len(first), block):
        part = first[at:at + block]
        rows = max(1, 65_536 // len(part))
        for j in range(0, k, rows):
            x = part[None, :] + shifts[j:j + rows, None]
            x ^= x >> np.uint32(15)
            x *= np.uint32(0x2C1B3C6D)
            x ^= x >> np.uint32(12)
            x *= np.uint32(0x297A2D39)
            np.minimum(out[j:j + rows], x.min(axis=1), out=out[j:j + rows])
    return out


def band_hashes(sig: np.ndarray, bands: int = BANDS, rows: int = ROWS) -> np.ndarray:
    """One 64-bit key a band; the band's number is hashed in."""
    parts = sig.reshape(bands, rows).astype(np.uint64)
    h = np.arange(1, bands + 1, dtype=np.uint64)
    for i in range(rows):
        h = mix64((h + parts[:, i]) * np.uint64(0x9E3779B97F4A7C15))
    return h.view(np.int64)


def set_key(shingles: np.ndarray) -> bytes:
    """128-bit name of a whole set: equal sets, equal names."""
    return xxhash.xxh128_digest(shingles.tobytes())
