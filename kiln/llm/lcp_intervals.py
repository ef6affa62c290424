"""Maximal repeats of many short segments: an enhanced suffix array and its common-prefix intervals.

Segments are byte strings; a suffix starts at each place that leaves at least
``least`` bytes. The suffixes are sorted, neighbours' common prefixes (which
end with a segment) are measured, and a stack scan lists every interval of
suffixes with a common prefix of ``least`` bytes or more. An interval whose
suffixes all follow the same byte only repeats the interval one byte earlier
and is left out; a suffix at a segment's start counts as following anything.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np


def suffix_rows(text: np.ndarray, start: np.ndarray, length: np.ndarray, least: int):
    """(segment, offset, length, big-endian words) of every suffix of at least ``least`` bytes."""
    n = np.maximum(length - least + 1, 0)
    segment = np.repeat(np.arange(len(start)), n)
    offset = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
    left = length[segment] - offset
    width = -(-int(left.max(initial=8)) // 8) * 8
    padded = np.concatenate([text, np.zeros(width, np.uint8)])
    rows = np.lib.stride_tricks.sliding_window_view(padded, width)[start[segment] + offset]
    rows[np.arange(width)[None, :] >= left[:, None]] = 0
    return segment, offset, left, np.ascontiguousarray(rows).view(">u8").astype(np.uint64)


def sort_suffixes(words: np.ndarray, left: np.ndarray) -> np.ndarray:
    """Order by bytes, a prefix before what it begins."""
    return np.lexsort([left, *words.T[::-1]])


def common_prefixes(words: np.ndarray, left: np.ndarray) -> np.ndarray:
    """Common prefix of each sorted suffix with the one before it (0 for the first)."""
    out = np.zeros(len(words), np.int64)
    if len(words) < 2:
        return out
    differ = words[1:] ^ words[:-1]
    first = (differ != 0).argmax(1)
    x = differ[np.arange(len(differ)), first]
    same = np.zeros(len(x), np.int64)
    for bits in (32, 16, 8):       # whole leading zero bytes of the first word that differs
        low = x < (np.uint64(1) << np.uint64(64 - bits))
        same += np.where(low, bits // 8, 0)
        x = np.where(low, x << np.uint64(bits), x)
    equal = (differ == 0).all(1)
    out[1:] = np.minimum(np.where(equal, words.shape[1] * 8, first * 8 + same), np.minimum(left[1:], left[:-1]))
    return out


def intervals(lcp: np.ndarray, least: int) -> Iterator[tuple[int, int, int]]:
    """(depth, first, last) of every common-prefix interval of depth ``least`` or more, inner ones first."""
    stack: list[tuple[int, int]] = []      # (depth, first) of the open intervals, depths rising
    values = lcp.tolist()
    hot = np.flatnonzero(lcp >= least)
    previous = -2
    for i in hot.tolist():
        if i != previous + 1:              # a gap closes everything
            while stack:
                depth, first = stack.pop()
                yield depth, first, previous
        depth, first = values[i], i - 1
        while stack and stack[-1][0] > depth:
            d, first = stack.pop()
            yield d, first, i - 1
        if not stack or stack[-1][0] < depth:
            stack.append((depth, first))
        previous = i
    while stack:
        depth, first = stack.pop()
        yield depth, first, previous


def maximal_repeats(text: np.ndarray, start: np.ndarray, length: np.ndarray,
                    least: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(length, segments, offsets) of every group of equal strings that no byte before or after all of them extends."""
    segment, offset, left, words = suffix_rows(text, start, length, least)
    order = sort_suffixes(words, left)
    segment, offset, left, words = segment[order], offset[order], left[order], words[order]
    before = np.where(offset > 0, text[np.maximum(start[segment] + offset - 1, 0)].astype(np.int64), -1)
    # a run of equal signs before neighbours ends here; a segment's start differs from everything
    change = np.concatenate([[0], np.cumsum((before[1:] != before[:-1]) | (before[1:] < 0))])
    for depth, first, last in intervals(common_prefixes(words, left), least):
        if change[last] != change[first]:
            yield depth, segment[first:last + 1], offset[first:last + 1]
