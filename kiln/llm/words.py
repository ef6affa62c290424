"""Words of many texts at once: byte classes, borders and 64-bit hashes in numpy.

A word is a longest run of ``0-9``, ``a-z`` (after lower-casing ``A-Z``) and
non-ASCII characters. In UTF-8 every byte of a non-ASCII character is 0x80 or
higher, so words are runs of byte classes.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np


def _folded() -> bytes:
    table = bytearray(256)
    for b in range(256):
        if 48 <= b <= 57 or 97 <= b <= 122 or b >= 0x80:
            table[b] = b
        elif 65 <= b <= 90:
            table[b] = b + 32
    return bytes(table)


#: each byte as it counts in a word, 0 outside words
FOLDED = _folded()
# odd multiplier of the polynomial hash, its inverse modulo 2**64, and the finaliser's multipliers (fixed values)
BASE = 0x9E3779B97F4A7C15
INVERSE = pow(BASE, -1, 1 << 64)
MIX = (np.uint64(0xFF51AFD7ED558CCD), np.uint64(0xC4CEB9FE1A85EC53))


def mix(h: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every bit."""
    h = h ^ (h >> np.uint64(33))
    h *= MIX[0]
    h ^= h >> np.uint64(33)
    h *= MIX[1]
    h ^= h >> np.uint64(33)
    return h


#: bytes hashed at once (more where one word is longer)
SECTION = 1 << 20


@lru_cache(maxsize=2)
def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    out = []
    for base in (BASE, INVERSE):
        p = np.full(n, base, np.uint64)
        p[0] = 1
        out.append(np.multiply.accumulate(p))
    return out[0], out[1]


def _hashes(folded: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Polynomial hashes of the words, by differences of running sums over sections that no word crosses."""
    out = np.empty(len(start), np.uint64)
    i = 0
    while i < len(start):
        j = max(i + 1, int(np.searchsorted(end, start[i] + SECTION, side="right")))
        a, z = int(start[i]), int(end[j - 1])
        powers, inverse = _powers(SECTION if z - a <= SECTION else 1 << (z - a).bit_length())
        total = np.zeros(z - a + 1, np.uint64)
        np.cumsum(folded[a:z] * powers[:z - a], out=total[1:])
        out[i:j] = (total[end[i:j] - a] - total[start[i:j] - a]) * inverse[start[i:j] - a]
        i = j
    return out


class Words:
    """Words of the texts in ``data`` (joined bytes) cut at ``offsets``.

    ``start``/``end``: byte positions in ``data``; ``doc``: text number;
    ``hash``: 64 bits of the folded word; ``first``: for each text, its first word
    (one more entry at the end).
    """

    def __init__(self, data: np.ndarray, offsets: np.ndarray):
        folded = np.frombuffer(data.tobytes().translate(FOLDED), np.uint8)
        inside = folded != 0
        starts, ends = inside.copy(), np.zeros(len(data), bool)
        starts[1:] &= ~inside[:-1]
        ends[:-1] = inside[:-1] & ~inside[1:]
        edges = offsets[(offsets > 0) & (offsets < len(data))]
        starts[edges] |= inside[edges]
        ends[edges - 1] |= inside[edges - 1]
        if len(data):
            ends[-1] |= inside[-1]
        self.start = np.flatnonzero(starts)
        self.end = np.flatnonzero(ends) + 1
        self.first = np.searchsorted(self.start, offsets)
        self.doc = np.repeat(np.arange(len(offsets) - 1), np.diff(self.first))
        self.hash = mix(_hashes(folded, self.start, self.end) + (self.end - self.start).astype(np.uint64))
