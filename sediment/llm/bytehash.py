"""Hashes of many byte ranges of one buffer at once, as numpy arrays."""

from __future__ import annotations

import numpy as np
import xxhash

from sediment.llm.mph import mix

LONG = 48  # longer ranges are hashed one by one
BASE = 0x9E3779B97F4A7C15
_U = np.uint64
_TABLE = mix(np.arange(1, 257, dtype=np.uint64))
_SECOND = mix(np.arange(1001, 1257, dtype=np.uint64))
_FOLD = np.arange(256, dtype=np.uint8)
_FOLD[65:91] += 32


def blanks(data: np.ndarray) -> np.ndarray:
    """Where ASCII white space stands."""
    return (data == 32) | ((data >= 9) & (data <= 13))


def range_hashes(data: np.ndarray, start: np.ndarray, length: np.ndarray, fold: bool,
                 second: bool = False) -> tuple[np.ndarray, np.ndarray | None]:
    """A 64-bit hash of each range (fold: of its A-Z lower-cased bytes), and a second one.

    A polynomial over hashed bytes, a column of bytes at a time for the ranges still that long.
    """
    # Long ranges first; a radix sort, as the keys have 8 bits.
    order = np.argsort((LONG + 1 - np.minimum(length, LONG + 1)).astype(np.uint8), kind="stable")
    begin, left = start[order], length[order]
    short = int(np.count_nonzero(length > LONG))
    one = np.zeros(len(order), np.uint64)
    two = np.zeros(len(order), np.uint64) if second else None
    if len(order) > short:
        at_least = np.bincount(left[short:], minlength=2)[::-1].cumsum()[::-1]
        ends = short + at_least[1:]
        for at, live in enumerate(ends.tolist()):
            span = slice(short, live)
            byte = data[begin[span] + at]
            if fold:
                byte = _FOLD[byte]
            one[span] = one[span] * _U(BASE) + _TABLE[byte]
            if second:
                two[span] = two[span] * _U(0xD6E8FEB86659FD93) + _SECOND[byte]
    for i in range(short):
        own = data[begin[i]:begin[i] + left[i]].tobytes()
        full = xxhash.xxh3_128_intdigest(own.lower() if fold else own)
        one[i] = full & 0xFFFFFFFFFFFFFFFF
        if second:
            two[i] = full >> 64
    out = np.empty_like(one)
    out[order] = mix(one + left.astype(np.uint64))
    if not second:
        return out, None
    other = np.empty_like(two)
    other[order] = mix(two ^ left.astype(np.uint64))
    return out, other
