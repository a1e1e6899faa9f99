"""Fingerprints of many strings within one array of bytes, and places of repeated fingerprints.

In ``prints`` a string is the polynomial of its bytes at a fixed point, modulo the prime 2**61 - 1. Two different strings of n
bytes are two polynomials that agree in at most n points, so no pattern of bytes makes them alike at a point drawn
at random, as there is for sums modulo a power of two. Points of two numbers (``point`` 0 and 1) are independent.
"""

from __future__ import annotations

import functools

import numpy as np
import pandas as pd

_TILE = 1 << 19
_PRIME = (1 << 61) - 1
_P = np.uint64(_PRIME)
#: Points drawn at random below the prime.
_POINTS = (0x0F3A5C94D2E1B78D, 0x19D7B3E06C5A42F1)


def u64(value: int) -> np.uint64:
    return np.uint64(value)


def _reduced(x: np.ndarray) -> np.ndarray:
    """x modulo the prime, for any x below 2**64."""
    x = (x & _P) + (x >> u64(61))
    return np.where(x >= _P, x - _P, x)


def times(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """a * b modulo the prime, from halves of 30 and 31 bits: 2**61 counts as 1."""
    low = u64((1 << 31) - 1)
    a1, a0, b1, b0 = a >> u64(31), a & low, b >> u64(31), b & low
    middle = a1 * b0 + a0 * b1
    carried = (middle >> u64(30)) + ((middle & u64((1 << 30) - 1)) << u64(31))
    return _reduced(u64(2) * a1 * b1 + carried + _reduced(a0 * b0))


@functools.lru_cache(maxsize=2)
def _powers(point: int, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Powers of a point, as low 30 bits and the rest, and powers of its inverse; doubled until there are ``size``."""

    def powers(of: int) -> np.ndarray:
        result = np.array([1], np.uint64)
        while len(result) < size:
            result = np.concatenate([result, times(result, u64(pow(of, len(result), _PRIME)))])
        return result

    up = powers(_POINTS[point])
    return up & u64((1 << 30) - 1), up >> u64(30), powers(pow(_POINTS[point], -1, _PRIME))


def mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def prints(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, point: int = 0) -> np.ndarray:
    """64-bit fingerprints of the strings data[start:end], starts ascending.

    Sums of the bytes times powers are taken over a tile of the data; a string's is a difference of two of
    them, whatever its length, brought to power zero.
    """
    result = np.empty(len(starts), np.uint64)
    low = 0
    while low < len(starts):
        begin = int(starts[low])
        high = int(np.searchsorted(starts, begin + _TILE))
        s, e = starts[low:high] - begin, ends[low:high] - begin
        n = int(e.max())
        # Tables grow by doubling, so that they are made a few times however long the strings are.
        power0, power1, inverse = _powers(point, 1 << max(20, n.bit_length()))
        values = data[begin : begin + n].astype(np.uint64) + u64(1)
        lower, upper = (_sums(values * power[:n], s, e) for power in (power0, power1))
        # The upper part counts 2**30 times.
        raised = ((upper & u64((1 << 31) - 1)) << u64(30)) + (upper >> u64(31))
        total = _reduced(lower + _reduced(raised))
        result[low:high] = mix(times(total, inverse[s]) + (e - s).astype(np.uint64))
        low = high
    return result


def _sums(terms: np.ndarray, s: np.ndarray, e: np.ndarray) -> np.ndarray:
    """Sums of terms[s:e] modulo the prime; terms have at most 40 bits.

    Running sums start anew every 2**20 terms, so they stay below 2**60; the sums of whole stretches before are
    kept modulo the prime.
    """
    size = 1 << 20
    if len(terms) <= size:
        running = np.zeros(len(terms) + 1, np.uint64)
        np.cumsum(terms, out=running[1:])
        return _reduced(running[e] - running[s])
    at = np.empty(len(terms) + 1, np.uint64)
    whole = u64(0)
    for i in range(0, len(terms), size):
        part = np.cumsum(terms[i : i + size])
        at[i] = whole
        at[i + 1 : i + len(part) + 1] = _reduced(part + whole)
        whole = at[i + len(part)]
    return _reduced(at[e] + (_P - at[s]))


def windows(data: np.ndarray, at: np.ndarray, length: int, point: int = 0) -> np.ndarray:
    """64-bit fingerprints of the strings of one length that begin at ``at``, all within ``data``.

    Eight bytes at a time go through a bijection that mixes all bits, so only chance makes two strings alike.
    """
    if length < 8:
        return prints(data, at, at + length, point)
    words = np.ndarray((max(len(data) - 7, 0),), "<u8", buffer=np.ascontiguousarray(data), strides=(1,))
    step = u64(_POINTS[point] | 1)
    found = np.full(len(at), step, np.uint64)
    for offset in (*range(0, length - 8, 8), length - 8):
        found = mix(found ^ words[at + offset]) + step
    return found


def places(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct values, ascending, and the place of each value among them."""
    codes, distinct = pd.factorize(values)
    order = np.argsort(distinct)
    rank = np.empty(len(order), np.int64)
    rank[order] = np.arange(len(order))
    return distinct[order], rank[codes]
