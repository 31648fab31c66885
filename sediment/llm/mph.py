"""Minimal perfect hash over 64-bit keys, as plain numpy arrays.

Levels of bit arrays: at each level every remaining key is hashed to one of GAMMA positions per
remaining key; keys alone on their position are placed there, the others go to the next level.
A key's slot is the number of placed positions before its own.  About 3.7 bits a key.
"""

from __future__ import annotations

import numpy as np

GAMMA = 2
MAX_LEVELS = 64


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (multiply and xor-shift)."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def _position(keys: np.ndarray, level: int, size: int) -> np.ndarray:
    h = mix(keys + np.uint64((level + 1) * 0x9E3779B97F4A7C15 & (2 ** 64 - 1)))
    return ((h >> np.uint64(32)) * np.uint64(size)) >> np.uint64(32)


class MinimalPerfectHash:
    """Slots 0..n-1 for n distinct keys.  An unknown key gets some slot, or -1."""

    def __init__(self, sizes: np.ndarray, bits: np.ndarray):
        self.sizes, self.words = sizes, bits
        ones = np.bitwise_count(bits).astype(np.int64)
        self.before = np.concatenate(([0], np.cumsum(ones)))

    @classmethod
    def build(cls, keys: np.ndarray) -> MinimalPerfectHash:
        keys = keys.astype(np.uint64)
        sizes, words = [], []
        for level in range(MAX_LEVELS):
            if not len(keys):
                break
            size = -(-len(keys) * GAMMA // 64) * 64
            at = _position(keys, level, size)
            alone = np.bincount(at.astype(np.int64), minlength=size) == 1
            sizes.append(size)
            words.append(np.packbits(alone, bitorder="little").view(np.uint64))
            keys = keys[~alone[at.astype(np.int64)]]
        if len(keys):
            raise ValueError("keys repeat")
        empty = np.zeros(0, np.uint64)
        return cls(np.array(sizes, np.int64), np.concatenate(words) if words else empty)

    def slots(self, keys: np.ndarray) -> np.ndarray:
        keys = keys.astype(np.uint64)
        out = np.full(len(keys), -1, np.int64)
        left, start = np.arange(len(keys)), 0
        for level, size in enumerate(self.sizes.tolist()):
            if not len(left):
                break
            at = _position(keys[left], level, size).astype(np.int64) + start
            word, bit = at >> 6, (at & 63).astype(np.uint64)
            held = self.words[word]
            placed = ((held >> bit) & np.uint64(1)).astype(bool)
            below = held & ((np.uint64(1) << bit) - np.uint64(1))
            slot = self.before[word] + np.bitwise_count(below)
            out[left[placed]] = slot[placed]
            left, start = left[~placed], start + size
        return out
