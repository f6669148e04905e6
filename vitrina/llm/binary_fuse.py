"""Static 3-wise binary fuse filters with 8-bit fingerprints (Graf and Lemire 2022), built with whole-array steps."""

from __future__ import annotations

import math
import struct

import numpy as np

from vitrina.llm.common import mix64

_HEAD = struct.Struct("<QII")


def _places(keys: np.ndarray, seed: int, segment: int, segments: int) -> tuple[np.ndarray, np.ndarray]:
    """Each key's three slots, in consecutive segments, and its fingerprint."""
    with np.errstate(over="ignore"):
        h = mix64(keys + np.uint64(seed))
    first = ((h >> np.uint64(32)) * np.uint64(segment * segments) >> np.uint64(32)).astype(np.int64)
    mask = segment - 1
    second = (first + segment) ^ ((h >> np.uint64(18)).astype(np.int64) & mask)
    third = (first + 2 * segment) ^ (h.astype(np.int64) & mask)
    return np.stack((first, second, third), axis=1), (h ^ (h >> np.uint64(32))).astype(np.uint8)


def build(keys: np.ndarray) -> bytes:
    """The filter of a set of 64-bit keys, as bytes."""
    keys = np.unique(keys.astype(np.uint64))
    n = len(keys)
    segment = 1 << max(2, math.floor(math.log(max(n, 2)) / math.log(3.33) + 2.25))
    room = round(n * max(1.125, 0.875 + 0.25 * math.log(1e6) / math.log(max(n, 2))))
    segments = max(1, -(-room // segment) - 2)
    size = (segments + 2) * segment
    for seed in range(1, 1000):
        slots, prints = _places(keys, seed, segment, segments)
        uses = np.bincount(slots.ravel(), minlength=size)
        users = np.zeros(size, np.int64)  # the xor of the slot's keys
        np.bitwise_xor.at(users, slots.ravel(), np.repeat(np.arange(n), 3))
        peeled: list[tuple[np.ndarray, np.ndarray]] = []
        single = np.flatnonzero(uses == 1)
        while len(single):
            key, at = np.unique(users[single], return_index=True)
            peeled.append((key, single[at]))
            touched = slots[key].ravel()
            np.subtract.at(uses, touched, 1)
            np.bitwise_xor.at(users, touched, np.repeat(key, 3))
            touched = np.unique(touched)
            single = touched[uses[touched] == 1]
        if sum(len(key) for key, _ in peeled) == n:
            table = np.zeros(size, np.uint8)
            for key, own in reversed(peeled):
                table[own] = prints[key] ^ np.bitwise_xor.reduce(table[slots[key]], axis=1)
            return _HEAD.pack(seed, segment, segments) + table.tobytes()
    raise RuntimeError("no seed gives a filter for these keys")


def contains(filter_bytes: bytes, keys: np.ndarray) -> np.ndarray:
    """True for every key of the set, and for about one in 256 of the others."""
    seed, segment, segments = _HEAD.unpack_from(filter_bytes)
    table = np.frombuffer(filter_bytes, np.uint8, offset=_HEAD.size)
    slots, prints = _places(keys.astype(np.uint64), seed, segment, segments)
    return np.bitwise_xor.reduce(table[slots], axis=1) == prints
