"""Operator 9: benchmark decontamination with an FM-index per training shard.

Words as in ``words.Words``. An item's windows are its runs of ``WINDOW``
consecutive words; a shorter item is one window. Each task builds, for every
shard (``SHARD_BYTES`` of document text), an FM-index of the shard's words,
searches all windows backward through the wavelet ranks, locates the
occurrences by sampled suffix positions and merges the hit words into removal
spans.

The index holds the words that occur in some item; runs of other words are one
separator, and a run of item words shorter than the shortest window is left
out, since no window can lie in it. Documents are never shuffled.

The benchmark goes to the tasks in blocks of at most ``BLOCK_BYTES`` of item
text, so that no broadcast grows with it. A task looks for each block's windows
in the same unchanged text, one block in memory at a time, and unites the hit
words and items before it counts or cuts: the result does not depend on the
number of blocks.

Defined cases: null text has no words; items without words have no windows;
the windows of an item without an item_id hit words as any others, but such an
item is not counted or listed; repeated item_ids count once; repeated documents
are judged alike, each on its own row; a very long document is a shard of its
own; there are no ties (overlapping windows unite); empty tables give no hits
or an empty result; other columns are ignored (``remove_contamination`` keeps
them).
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import doc_columns, slices, small_batches, task, text_bytes
from .fm_index import FMIndex
from .words import Words

WINDOW = 10
SHARD_BYTES = 3 << 20
BLOCK_BYTES = 4 << 20


@dataclass(frozen=True)
class Windows:
    """Distinct windows of a block of items as codes into the items' words."""

    vocabulary: np.ndarray     # sorted word hashes; code = place + 1
    phrases: np.ndarray        # windows x WINDOW codes, padded with 0
    lengths: np.ndarray
    item_first: np.ndarray     # window -> its items: item_of[item_first[w]:item_first[w + 1]]
    item_of: np.ndarray
    item_ids: list[str]


def item_windows(item_ids: list, texts: list[str | None], window: int = WINDOW) -> Windows:
    words = Words(*text_bytes(pa.array([t or "" for t in texts], pa.large_string())))
    vocabulary, code = np.unique(words.hash, return_inverse=True)
    names = sorted({str(i) for i in item_ids if i is not None})
    number = {n: k for k, n in enumerate(names)}
    found: dict[tuple, set[int]] = {}
    for i, (item, a, z) in enumerate(zip(item_ids, words.first[:-1], words.first[1:])):
        own = (code[a:z] + 1).tolist()
        if not own:
            continue
        for k in range(max(1, len(own) - window + 1)):
            of = found.setdefault(tuple(own[k:k + window]), set())
            if item is not None:                       # an item without an id hits words but has no name to list
                of.add(number[str(item)])
    phrases = np.zeros((len(found), window), np.int64)
    lengths = np.array([len(p) for p in found], np.int64)
    for k, p in enumerate(found):
        phrases[k, :len(p)] = p
    items = [sorted(v) for v in found.values()]
    first = np.concatenate([[0], np.cumsum([len(v) for v in items])]).astype(np.int64)
    return Windows(vocabulary, phrases, lengths, first, np.array([x for v in items for x in v], np.int64), names)


def expand(low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(owner, value) for every integer of each range [low, high)."""
    n = np.maximum(high - low, 0)
    owner = np.repeat(np.arange(len(n)), n)
    return owner, np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + low[owner]


def find_windows(words: Words, windows: Windows) -> tuple[np.ndarray, np.ndarray]:
    """(window, first word) of every occurrence of a window within one document."""
    none = np.zeros(0, np.int64)
    if not len(windows.lengths) or not len(words.hash):
        return none, none
    at = np.searchsorted(windows.vocabulary, words.hash)
    at[at == len(windows.vocabulary)] = 0
    code = np.where(windows.vocabulary[at] == words.hash, at + 1, 0)
    # runs of item words within a document
    begins = code != 0
    begins[1:] &= (code[:-1] == 0) | (words.doc[1:] != words.doc[:-1])
    begin = np.flatnonzero(begins)
    if not len(begin):
        return none, none
    stops = np.flatnonzero((code != 0) & np.append((code[1:] == 0) | (words.doc[1:] != words.doc[:-1]), True)) + 1
    long = stops - begin >= windows.lengths.min()
    begin, stops = begin[long], stops[long]
    if not len(begin):
        return none, none
    _, place = expand(begin, stops + 1)      # one place more for the separator
    ends = np.cumsum(stops - begin + 1) - 1
    codes = code[np.minimum(place, len(code) - 1)]
    codes[ends] = 0
    index = FMIndex(codes, len(windows.vocabulary))
    low, high = index.search(windows.phrases, windows.lengths)
    window, row = expand(low, high)
    return window, place[index.locate(row)]


def shard_hits(words: Words, windows: Windows) -> tuple[np.ndarray, list[list[str]]]:
    """(whether each word is hit, the sorted ids of the items found in each document)."""
    window, first = find_windows(words, windows)
    change = np.zeros(len(words.hash) + 1, np.int64)
    np.add.at(change, first, 1)
    np.add.at(change, first + windows.lengths[window], -1)
    n_docs = len(words.first) - 1
    items: list[list[str]] = [[] for _ in range(n_docs)]
    if len(window) and len(windows.item_ids):
        _, place = expand(windows.item_first[window], windows.item_first[window + 1])
        n = windows.item_first[window + 1] - windows.item_first[window]
        pairs = np.unique(np.repeat(words.doc[first], n) * len(windows.item_ids) + windows.item_of[place])
        for doc, item in zip(*(x.tolist() for x in np.divmod(pairs, len(windows.item_ids)))):
            items[doc].append(windows.item_ids[item])
    return np.cumsum(change[:-1]) > 0, items


def spans_of(hit: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """[first, end) of the runs of True."""
    edge = np.diff(np.concatenate([[0], hit.astype(np.int8), [0]]))
    return np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)


def united_hits(words: Words, blocks: Iterable[Windows]) -> tuple[np.ndarray, list[list[str]]]:
    """``shard_hits`` of all blocks' windows together, each found in the same words."""
    hit = np.zeros(len(words.hash), bool)
    items: list[list[str]] = [[] for _ in range(len(words.first) - 1)]
    for windows in blocks:
        own, found = shard_hits(words, windows)
        hit |= own
        for doc, more in enumerate(found):
            if more:
                items[doc] = sorted({*items[doc], *more})
    return hit, items


def _blocks(benchmark: DataFrame) -> list[Broadcast]:
    """The benchmark's windows in blocks of bounded item text (the driver's Python holds one block at a time)."""
    context = benchmark.sparkSession.sparkContext
    items = benchmark.select(F.col("item_id").cast("string").alias("item_id"), F.col("text").cast("string"))
    size = items.agg(F.coalesce(F.sum(F.octet_length("text") + 16), F.lit(0))).first()[0]
    n = max(1, -(-size // BLOCK_BYTES))
    out = []
    for k in range(n):
        rows = items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(n)) == k).orderBy("item_id", "text").collect()
        out.append(context.broadcast(item_windows([r["item_id"] for r in rows], [r["text"] for r in rows])))
    return out


def _in_turn(blocks: list[Broadcast]) -> Iterator[Windows]:
    """Each block's windows; of several blocks a worker keeps none."""
    for block in blocks:
        yield block.value
        if len(blocks) > 1:
            vars(block).pop("_value", None)


def _scan(docs: DataFrame, blocks: list[Broadcast], schema: str, make) -> DataFrame:
    """``make(batch, words, hit, items)`` for each shard of the documents."""
    small_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, limit=SHARD_BYTES):
            data, offsets = text_bytes(batch.column("text"))
            words = Words(data, offsets)
            yield make(batch, words, *united_hits(words, _in_turn(blocks)))

    return docs.mapInArrow(task(run), schema)


def _digest(items: list[str]) -> str:
    return hashlib.sha256(",".join(sorted(items)).encode()).hexdigest()


SCHEMA = "doc_id long, n_words long, n_hit long, n_items long, items_sha256 string, contaminated boolean"


def _counts(batch: pa.RecordBatch, words: Words, hit: np.ndarray, items: list[list[str]]) -> pa.RecordBatch:
    total = np.concatenate([[0], np.cumsum(hit)])
    n_hit = total[words.first[1:]] - total[words.first[:-1]]
    return pa.RecordBatch.from_arrays(
        [batch.column("doc_id"), pa.array(np.diff(words.first)), pa.array(n_hit),
         pa.array([len(x) for x in items], pa.int64()), pa.array([_digest(x) for x in items]), pa.array(n_hit > 0)],
        ["doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated"])


def contamination(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """Per document: its words, those covered by an occurring window, and a digest of the items found."""
    return _scan(doc_columns(docs), _blocks(benchmark), SCHEMA, _counts)


def remove_contamination(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """``docs`` with each run of hit words, from its first to its last character, taken out of the text.

    Columns are kept; a null text stays null.
    """
    names = docs.columns

    def cut(batch: pa.RecordBatch, words: Words, hit: np.ndarray, items: list[list[str]]) -> pa.RecordBatch:
        texts = batch.column("text").to_pylist()
        data, offsets = text_bytes(batch.column("text"))
        for k in np.unique(words.doc[hit]):
            a, z = words.first[k], words.first[k + 1]
            first, end = spans_of(hit[a:z])
            edges = [offsets[k], *np.column_stack([words.start[a:z][first], words.end[a:z][end - 1]]).ravel(),
                     offsets[k + 1]]
            texts[k] = b"".join(data[x:y].tobytes() for x, y in zip(edges[::2], edges[1::2])).decode()
        columns = [pa.array(texts, batch.schema.field("text").type) if n == "text" else batch.column(i)
                   for i, n in enumerate(names)]
        return pa.RecordBatch.from_arrays(columns, names)

    return _scan(docs, _blocks(benchmark), docs.schema, cut)
