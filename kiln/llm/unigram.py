"""Operator 10: token counts by trie-shared dynamic programming.

A unigram model gives every vocabulary piece a log-probability; a pre-token's
segmentation is the sequence of pieces with the highest sum (ties: fewer
pieces). The forward score of a prefix depends on that prefix alone, so the
distinct pre-tokens of a task go into one trie whose nodes hold the forward
score and the piece count of their prefix: a shared prefix is scored once, and
a pre-token's count is read at its terminal node.

The vocabulary is a rank file; its pieces get Zipf log-probabilities by rank
(``-log(rank + ZIPF_SHIFT)``, normalised), so nothing is trained. Every byte
is a piece, so each pre-token has a segmentation.

Spark partitions the documents; no shuffle, no collect. The trie is emptied
when it exceeds ``MAX_NODES``.

Defined cases: null text is empty; an empty text has 0 words, 0 tokens and
score 0; repeated rows give repeated rows; an empty table gives an empty
result; other columns are ignored; a very long pre-token is one path.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .bpe import read_ranks
from .common import doc_columns, slices, strings, task
from .pretokens import Cache, Units

ZIPF_SHIFT = 2.7
MAX_NODES = 400_000
TRIE_SLICE = 4 << 20


def zipf_scores(ranks: dict[bytes, int]) -> dict[bytes, float]:
    norm = math.log(math.fsum(1 / (r + ZIPF_SHIFT) for r in ranks.values()))
    return {t: -math.log(r + ZIPF_SHIFT) - norm for t, r in ranks.items()}


class ForwardTrie:
    """Trie over bytes; each node has the best forward score of its prefix and that path's piece count."""

    def __init__(self, scores: dict[bytes, float], max_nodes: int = MAX_NODES):
        self.scores, self.max_nodes = scores, max_nodes
        self.longest = max(map(len, scores))
        # how long a piece ending in this byte can be
        self.reach = [0] * 256
        for t in scores:
            self.reach[t[-1]] = max(self.reach[t[-1]], len(t))
        self.clear()

    def clear(self) -> None:
        self.child: dict[int, int] = {}
        self.best, self.count = [0.0], [0]

    def insert(self, word: bytes) -> int:
        """The terminal node of ``word``; only prefixes not yet in the trie are scored."""
        child, best, count, scores, reach = self.child, self.best, self.count, self.scores, self.reach
        node, path = 0, [0]
        for end, byte in enumerate(word, 1):
            key = node << 8 | byte
            node = child.get(key, 0)
            if not node:
                top, n = -math.inf, 0
                for start in range(max(0, end - reach[byte]), end):
                    score = scores.get(word[start:end])
                    if score is not None:
                        before = path[start]
                        score += best[before]
                        if score > top or score == top and count[before] + 1 < n:
                            top, n = score, count[before] + 1
                node = child[key] = len(best)
                best.append(top)
                count.append(n)
            path.append(node)
        return node

    def segment(self, words: list[bytes]) -> list[tuple[int, float]]:
        """(piece count, forward score) at each word's terminal node."""
        out = []
        for w in words:
            if len(self.best) > self.max_nodes:
                self.clear()
            node = self.insert(w)
            out.append((self.count[node], self.best[node]))
        return out


class UnigramCounter:
    def __init__(self, path: str, pattern: str):
        import regex
        self.find = regex.compile(pattern).findall
        self.trie = ForwardTrie(zipf_scores(read_ranks(path)))
        self.cache = Cache(self._units)

    def _units(self, units: list[str]) -> list[tuple[int, int, float]]:
        """(words, tokens, score) of each unit."""
        words = [[w.encode() for w in self.find(u)] for u in units]
        distinct = sorted({w for ws in words for w in ws})
        got = dict(zip(distinct, self.trie.segment(distinct)))
        return [(len(ws), sum(got[w][0] for w in ws), math.fsum(got[w][1] for w in ws)) for ws in words]

    def count(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        units = Units(texts)
        table = np.array(self.cache.look_up(units.distinct), np.float64).reshape(-1, 3)
        words, tokens = (units.sums(table[:, k].astype(np.int64)) for k in (0, 1))
        scores = [float(table[units.codes[a:z], 2].sum()) for a, z in zip(units.offsets[:-1], units.offsets[1:])]
        return words, tokens, np.array(scores)


def token_counts(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """Per document: pre-tokens, unigram tokens and the log-probability of the best segmentation."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = UnigramCounter(path, pattern)
        for batch in slices(batches, limit=TRIE_SLICE):
            words, tokens, scores = c.count(strings(batch.column(1)))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(words), pa.array(tokens), pa.array(scores)],
                ["doc_id", "n_words", "n_tokens", "score"])

    return doc_columns(docs).mapInArrow(task(run), "doc_id long, n_words long, n_tokens long, score double")
