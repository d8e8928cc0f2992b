"""Fingerprints and minima of a text's word shingles, for use inside tasks."""

from __future__ import annotations

import numpy as np
import xxhash

SEED, CHUNK = 42, 1 << 10
#: A pair of texts that share 0.8 of their shingles agrees on all six minima of one of 24 bands with a probability of 0.9993.
BANDS, ROWS = 24, 6
#: Bits in which the parities of two sets differ are at most as many as the elements in one set alone.
PARITIES = 512


def hashes(text: bytes | None, words: int) -> np.ndarray:
    """XXH64 of each word shingle, repeats included; a text of fewer words is one shingle, one without words has none.

    bytes.lower() and bytes.split() know ASCII letters and white space only.
    """
    found = (text or b"").lower().split()
    if not found:
        return np.empty(0, np.uint64)
    joined, ends = b" ".join(found), np.cumsum([len(w) + 1 for w in found])
    width = min(words, len(found))
    starts, stops = [0, *ends[: len(found) - width].tolist()], (ends[width - 1 :] - 1).tolist()
    digest = xxhash.xxh64_intdigest
    return np.array([digest(joined[a:b], SEED) for a, b in zip(starts, stops, strict=True)], np.uint64)


def simhash(h: np.ndarray) -> int:
    """Signed 64-bit fingerprint: a bit is 1 if it is set in over half of ``h``; zero for none."""
    ones = np.zeros(64, np.int64)
    for k in range(0, len(h), CHUNK):
        ones += np.unpackbits(h[k : k + CHUNK].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(h), bitorder="little").view(np.int64)[0])


def permutations() -> tuple[np.ndarray, np.ndarray]:
    random = np.random.default_rng(SEED)
    multipliers, offsets = (random.integers(0, 1 << 63, BANDS * ROWS, np.uint64) * np.uint64(2) + np.uint64(1) for _ in range(2))
    return multipliers, offsets


def buckets(h: np.ndarray, multipliers: np.ndarray, offsets: np.ndarray) -> list[int]:
    """One key per band of minima; none for a text without words."""
    if not len(h):
        return []
    least = np.full(len(multipliers), np.iinfo(np.uint64).max, np.uint64)
    for k in range(0, len(h), CHUNK):
        np.minimum(least, (h[k : k + CHUNK, None] * multipliers + offsets).min(axis=0), out=least)
    return [xxhash.xxh64_intdigest(least[k * ROWS : (k + 1) * ROWS].tobytes(), k) - (1 << 63) for k in range(BANDS)]


def parities(h: np.ndarray) -> np.ndarray:
    """Of the distinct hashes ``h``, for each of 512 bins whether it holds an odd number, as eight longs."""
    odd = np.bincount((h % np.uint64(PARITIES)).astype(np.int64), minlength=PARITIES) & 1
    return np.packbits(odd.astype(np.uint8), bitorder="little").view(np.int64)
