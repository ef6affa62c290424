"""An FM-index over a sequence of word codes: suffix array, wavelet matrix, sampled positions.

Codes are 1..n; 0 is a separator that no phrase contains. Suffixes end, for
comparison, at their first separator, each of which counts as a sign of its
own. Everything is vectorised over the phrases searched.
"""

from __future__ import annotations

import numpy as np

#: every SAMPLE-th position of the sequence, and every one behind a separator, keeps its place
SAMPLE = 16


def suffix_array(codes: np.ndarray) -> np.ndarray:
    """Starts of all suffixes in order, by prefix doubling."""
    n = len(codes)
    separators = np.flatnonzero(codes == 0)
    rank = codes.astype(np.int64) + len(separators)
    rank[separators] = np.arange(len(separators))
    width = 1
    while True:
        after = np.zeros(n, np.int64)
        after[:max(0, n - width)] = rank[width:] + 1
        key = rank * np.int64(n + rank.max(initial=0) + 2) + after
        order = np.argsort(key, kind="stable")
        ordered = key[order]
        new = np.concatenate([[True], ordered[1:] != ordered[:-1]]) if n else np.zeros(0, bool)
        rank = np.empty(n, np.int64)
        rank[order] = np.flatnonzero(new)[np.cumsum(new) - 1] if n else []
        if new.all():
            return order
        width *= 2


class WaveletMatrix:
    """rank(code, i): how often ``code`` occurs before place i, for many (code, i) at once."""

    def __init__(self, seq: np.ndarray, bits: int):
        self.bits, self.ones, self.zeros = bits, [], []
        for level in range(bits - 1, -1, -1):
            bit = (seq >> level) & 1
            self.ones.append(np.concatenate([[0], np.cumsum(bit, dtype=np.int32)]))
            self.zeros.append(int(len(seq) - self.ones[-1][-1]))
            seq = np.concatenate([seq[bit == 0], seq[bit == 1]])

    def rank(self, code: np.ndarray, *places: np.ndarray) -> list[np.ndarray]:
        start, at = np.zeros(len(code), np.int64), [p.astype(np.int64) for p in places]
        for k, level in enumerate(range(self.bits - 1, -1, -1)):
            one = ((code >> level) & 1).astype(bool)
            ones, zeros = self.ones[k], self.zeros[k]
            start, *at = [np.where(one, zeros + ones[x], x - ones[x]) for x in (start, *at)]
        return [x - start for x in at]


class FMIndex:
    def __init__(self, codes: np.ndarray, n_codes: int):
        """``codes``: the sequence; a separator is added in front, so every place has one before it."""
        seq = np.concatenate([[0], codes]).astype(np.int64)
        order = suffix_array(seq)
        before = seq[order - 1]
        before[order == 0] = 0
        self.wavelet = WaveletMatrix(before, max(1, int(n_codes).bit_length()))
        self.first = np.concatenate([[0], np.cumsum(np.bincount(seq, minlength=n_codes + 1))])
        self.before = before
        self.sampled = (order % SAMPLE == 0) | (before == 0)
        self.slot = np.cumsum(self.sampled) - 1
        self.places = order[self.sampled]

    def search(self, phrases: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rows [low, high) of the suffixes that begin with each phrase (row of codes, padded on the right)."""
        low = np.zeros(len(phrases), np.int64)
        high = np.full(len(phrases), len(self.before), np.int64)
        for step in range(1, int(lengths.max(initial=0)) + 1):
            live = np.flatnonzero((lengths >= step) & (low < high))
            code = phrases[live, lengths[live] - step]
            a, b = self.wavelet.rank(code, low[live], high[live])
            low[live], high[live] = self.first[code] + a, self.first[code] + b
        return low, high

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """Places in the sequence of the suffixes in these rows: step back until a sampled one."""
        rows, steps = rows.copy(), np.zeros(len(rows), np.int64)
        walking = np.flatnonzero(~self.sampled[rows])
        while len(walking):
            code = self.before[rows[walking]]
            (r,) = self.wavelet.rank(code, rows[walking])
            rows[walking] = self.first[code] + r
            steps[walking] += 1
            walking = walking[~self.sampled[rows[walking]]]
        return self.places[self.slot[rows]] + steps - 1  # without the separator in front
