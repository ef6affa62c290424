"""Cutting text into units that a pre-tokenizer never looks across.

The pre-tokenizer patterns used here match runs of letters, digits or other
signs, each with at most one space before it, runs of white space, and
contractions behind an apostrophe. A match then never crosses
* the place before a space that a character follows which is not white space;
* the border between an ASCII letter and an ASCII sign other than the apostrophe;
* the border between an ASCII character and a line break or tab, and the place
  behind a single one that stands between ASCII characters.
Each distinct unit is tokenized once and a text is its units in order.
"""

from __future__ import annotations

from itertools import filterfalse

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from .common import text_bytes

#: entries that a task keeps between slices; keys longer than LONG characters are never kept
KEPT, LONG = 200_000, 64

# classes of bytes; UNSURE: part of a character that may be white space
LETTER, SIGN, SPACE, BREAK, APOSTROPHE, DIGIT, HIGH, UNSURE = range(8)


def _classes() -> np.ndarray:
    table = np.full(256, SIGN, np.uint8)
    for first, last in ((65, 90), (97, 122)):
        table[first:last + 1] = LETTER
    table[48:58] = DIGIT
    table[0x80:] = HIGH
    table[[0xC2, 0xE1, 0xE2, 0xE3]] = UNSURE
    table[0x1C:0x20] = UNSURE
    table[9:14] = BREAK
    table[32], table[39] = SPACE, APOSTROPHE
    return table


CLASS = _classes().tobytes()


ASCII = {LETTER, SIGN, APOSTROPHE, DIGIT}
# what a pair of neighbours says, as bits: a space that starts a unit; a border; the end of a break
SPACE_STARTS, BORDER, BREAK_ENDS = 1, 2, 4


def _pair_bits() -> bytes:
    bits = bytearray(256)
    for a in range(8):
        for b in range(8):
            bits[a * 8 + b] = (SPACE_STARTS * (a == SPACE and b in ASCII | {HIGH})
                               | BORDER * ((a, b) in ((LETTER, SIGN), (SIGN, LETTER)) or (a in ASCII and b == BREAK))
                               | BREAK_ENDS * (a == BREAK and b in ASCII))
    return bytes(bits)


PAIR_BITS = _pair_bits()


class Cache(dict):
    """Key -> value, filled by ``compute(list of keys)``; holds a bounded number between slices.

    Frequent keys come early, so the oldest entries are the ones kept.
    """

    def __init__(self, compute, kept: int = KEPT):
        super().__init__()
        self.compute, self.kept = compute, kept

    def fill(self, keys) -> None:
        if len(self) > self.kept:
            first = [(k, v) for (k, v), _ in zip(self.items(), range(self.kept)) if len(k) <= LONG]
            self.clear()
            self.update(first)
        new = list(dict.fromkeys(filterfalse(self.__contains__, keys)))
        if new:
            self.update(zip(new, self.compute(new)))

    def look_up(self, keys: list) -> list:
        self.fill(keys)
        return [self[k] for k in keys]


class Units:
    """A slice of texts (ASCII letters lower-cased on request) as codes into a list of distinct units, in order."""

    def __init__(self, texts: pa.Array, lower: bool = False):
        data, offsets = text_bytes(texts)
        raw = data.tobytes().lower() if lower else data.tobytes()  # bytes.lower: ASCII letters only
        kind = np.frombuffer(raw.translate(CLASS), np.uint8)
        starts = np.zeros(len(data) + 1, bool)
        if len(data) > 1:
            pair = kind[:-1] * np.uint8(8) + kind[1:]
            pair[offsets[(offsets > 0) & (offsets < len(data))] - 1] = 0  # no pair reaches into the next text
            bits = np.frombuffer(pair.tobytes().translate(PAIR_BITS), np.uint8)
            starts[1:-1] = (bits & BORDER) != 0
            starts[:-2] |= (bits & SPACE_STARTS) != 0
            breaks = np.flatnonzero(bits & BREAK_ENDS)
            single = breaks[(breaks > 0) & (bits[breaks - 1] & BORDER != 0)]  # the character before is ASCII
            starts[single + 1] = True
        starts[offsets] = True
        starts[len(data)] = False
        at = np.flatnonzero(starts)
        bounds = np.append(at, len(data)).astype(np.int32)
        flat = pa.StringArray.from_buffers(len(at), pa.py_buffer(bounds), pa.py_buffer(raw))
        coded = flat.dictionary_encode()
        self.distinct: list[str] = coded.dictionary.to_pylist()
        self.codes = np.asarray(coded.indices, np.int64)
        self.offsets = np.searchsorted(at, offsets)

    def join(self, values: pa.Array, separator) -> pa.Array:
        """Per text: its units' values joined, empty values left out."""
        codes, offsets = self.codes, self.offsets
        empty = np.asarray(pc.equal(pc.binary_length(values), 0))
        if empty.any():
            keep = ~empty[codes]
            codes, offsets = codes[keep], np.concatenate([[0], np.cumsum(keep)])[offsets]
        lists = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), values.take(pa.array(codes)))
        return pc.binary_join(lists, separator)

    def sums(self, values: np.ndarray) -> np.ndarray:
        """Per text: the sum of its units' values."""
        total = np.concatenate([[0], np.cumsum(values[self.codes])])
        return total[self.offsets[1:]] - total[self.offsets[:-1]]
