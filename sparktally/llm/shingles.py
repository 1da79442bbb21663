"""Word shingles, MinHash samples and exact set comparison, in numpy.

Everything here works on one text or one bounded group inside a task; Spark
partitions and shuffles the work.
"""

from __future__ import annotations

import numpy as np
import xxhash

from sparktally.llm.common import mix64

U64 = np.uint64
WIDTH = 5  # words in a shingle
_STEP = U64(0x9E3779B97F4A7C15)


def words_of(text: str) -> list[bytes]:
    """Maximal runs of characters other than the six ASCII white-space ones,
    A-Z lower-cased (both are the bytes methods' ASCII rules)."""
    return text.encode("utf-8").lower().split()


def hash_words(words: list[bytes]) -> np.ndarray:
    return np.array(list(map(xxhash.xxh64_intdigest, words)), dtype=np.uint64)


def shingle_hashes(words: np.ndarray, width: int = WIDTH) -> np.ndarray:
    """One hash per run of ``width`` word hashes; a shorter sequence is one
    shingle of its own length; no words, no shingle."""
    n = len(words)
    if n == 0:
        return words
    width = min(width, n)
    out = np.full(n - width + 1, U64(width), dtype=np.uint64)
    for j in range(width):
        out = out * _STEP + words[j : n - width + 1 + j]
    return mix64(out)


class MinHash:
    """``samples`` minima of 32-bit linear permutations, and what is folded
    from them: band keys and the odd sketch."""

    def __init__(self, samples: int, rows: int, bits: int = 1024, seed: int = 7):
        rng = np.random.default_rng(seed)
        self.mul = rng.integers(0, 1 << 31, samples, dtype=np.uint32) * np.uint32(2) + np.uint32(1)
        self.add = rng.integers(0, 1 << 32, samples, dtype=np.uint32)
        self.samples, self.rows, self.bits = samples, rows, bits
        self.slot = mix64(np.arange(1, samples + 1, dtype=np.uint64)) & U64(0xFFFFFFFF00000000)
        self.bands = samples // rows

    def minima(self, shingles: np.ndarray) -> np.ndarray:
        """uint32 minima; ``shingles`` must not be empty."""
        x = (shingles >> U64(32)).astype(np.uint32)
        low = None
        for a in range(0, len(x), 2048):
            h = np.multiply.outer(self.mul, x[a : a + 2048])
            h += self.add[:, None]
            m = h.min(axis=1)
            low = m if low is None else np.minimum(low, m)
        return low

    def minima_rows(self, shingles: np.ndarray) -> np.ndarray:
        """Minima of each row of a matrix of shingles: (rows, samples)."""
        x = (shingles >> U64(32)).astype(np.uint32)
        out = np.empty((len(x), self.samples), dtype=np.uint32)
        for i in range(self.samples):
            out[:, i] = (x * self.mul[i] + self.add[i]).min(axis=1)
        return out

    def band_keys(self, minima: np.ndarray) -> np.ndarray:
        """64-bit keys of the bands, the band's number included; ``minima``
        may be one vector or a matrix of them."""
        parts = minima.reshape(*minima.shape[:-1], self.bands, self.rows).astype(np.uint64)
        key = np.broadcast_to(np.arange(1, self.bands + 1, dtype=np.uint64), parts.shape[:-1])
        for j in range(self.rows):
            key = mix64(key * _STEP + parts[..., j])
        return key

    def odd_sketch(self, minima: np.ndarray) -> bytes:
        """Parity bitmap: every (slot, minimum) pair flips one bit, so bits
        left set in the XOR of two sketches come from differing samples."""
        at = mix64(self.slot | minima.astype(np.uint64)) % U64(self.bits)
        return np.packbits((np.bincount(at.astype(np.int64), minlength=self.bits) & 1).astype(np.uint8)).tobytes()


def overlap(a: np.ndarray, b: np.ndarray) -> int:
    """Size of the intersection of two sorted arrays without repeats."""
    if len(a) > len(b):
        a, b = b, a
    at = np.searchsorted(b, a)
    at[at == len(b)] = 0
    return int((b[at] == a).sum()) if len(b) else 0


def similar(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    """100 * |a & b| >= percent * |a | b|, exactly."""
    small, large = sorted((len(a), len(b)))
    if 100 * small < percent * large:
        return False
    both = overlap(a, b)
    return 100 * both >= percent * (len(a) + len(b) - both)
