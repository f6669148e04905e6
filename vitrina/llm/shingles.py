"""Word shingle sets of texts and their circulant MinHash signatures."""

from __future__ import annotations

import numpy as np
import xxhash

from vitrina.llm.common import REMEMBERED_WORDS, WordNumbers, mix64

_FACTORS = np.array([0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB, 0xD6E8FEB86659FD93, 0xC2B2AE3D27D4EB4F], np.uint64)


class ShingleSets:
    """Sorted sets of 64-bit hashes of 5-word shingles; remembers the hashes of words it has met, up to a bound.

    Words are what lies between \\x20 and \\x09-\\x0D, with A-Z lower-cased.  A text of one to four words has one
    shingle, all of them; a text without words has none.
    """

    def __init__(self, width: int = 5, remembered: int = REMEMBERED_WORDS) -> None:
        if not 1 <= width <= len(_FACTORS):
            raise ValueError("width must be 1 to 5")
        self.width, self.limit = width, remembered
        self._forget()

    def _forget(self) -> None:
        self.words, self.hashes = WordNumbers(), np.zeros(0, np.uint64)

    def __call__(self, texts: list[bytes]) -> list[np.ndarray]:
        if len(self.words) > self.limit:
            self._forget()
        # bytes.lower changes A-Z only, and bytes.split cuts at just these six white space bytes
        at, counts = self.words.number(texts, lambda t: t.lower().split())
        new = self.words.since(len(self.hashes))
        self.hashes = np.concatenate((self.hashes, np.array([xxhash.xxh3_64_intdigest(w) for w in new], np.uint64)))
        h, n = self.hashes[at], self.width
        with np.errstate(over="ignore"):
            full = np.zeros(max(0, len(h) - n + 1), np.uint64)
            for k in range(n):
                full += h[k:len(h) - n + 1 + k] * _FACTORS[k]
            full = mix64(full)
            out, end = [], 0
            for count in counts.tolist():
                start, end = end, end + count
                if count >= n:
                    out.append(np.unique(full[start:end - n + 1]))
                elif count:
                    few = (h[start:end] * _FACTORS[:count]).sum(dtype=np.uint64) + np.uint64(count)
                    out.append(mix64(np.array([few], np.uint64) ^ _FACTORS[4]))
                else:
                    out.append(np.zeros(0, np.uint64))
        return out


def circulant_signatures(sets: list[np.ndarray], size: int) -> np.ndarray:
    """MinHash coordinates (set x size) from two permutations of the 32-bit integers (Li and Li 2022).

    The first scatters the hashes; the second, shifted circularly by k, gives coordinate k.  Sets must not be empty.
    """
    out = np.empty((len(sets), size), np.uint32)
    first = 0
    while first < len(sets):
        last, total = first, 0
        while last < len(sets) and (last == first or total + len(sets[last]) <= 100_000):
            total += len(sets[last])
            last += 1
        with np.errstate(over="ignore"):
            scattered = (mix64(np.concatenate(sets[first:last]) ^ np.uint64(0x2545F4914F6CDD1D)) >> np.uint64(32)).astype(np.uint32)
            starts = np.cumsum([0] + [len(s) for s in sets[first:last - 1]])
            for k in range(size):
                x = scattered + np.uint32(k)
                x ^= x >> np.uint32(16)
                x *= np.uint32(0x7FEB352D)
                x ^= x >> np.uint32(15)
                x *= np.uint32(0x846CA68B)
                x ^= x >> np.uint32(16)
                out[first:last, k] = np.minimum.reduceat(x, starts)
        first = last
    return out


def band_keys(signatures: np.ndarray, rows: int) -> np.ndarray:
    """One 64-bit key (set x band) for each ``rows`` coordinates; keys of different bands differ."""
    bands = signatures.shape[1] // rows
    parts = signatures[:, :bands * rows].reshape(len(signatures), bands, rows).astype(np.uint64)
    with np.errstate(over="ignore"):
        key = np.broadcast_to(np.arange(1, bands + 1, dtype=np.uint64) * _FACTORS[0], parts.shape[:2]).copy()
        for k in range(rows):
            key = mix64(key ^ parts[:, :, k] * _FACTORS[1])
    return key


def shared(a: np.ndarray, b: np.ndarray) -> int:
    """Size of the intersection of two sorted sets."""
    if len(a) > len(b):
        a, b = b, a
    at = np.searchsorted(b, a)
    return int((b[np.minimum(at, len(b) - 1)] == a).sum()) if len(a) else 0
