"""Operator 2: removal of repeated byte strings with sharded enhanced suffix arrays.

A byte is removed where a string of ``MATCH`` bytes covers it that also starts
in a document with a smaller doc_id. All texts of a corpus do not fit one
suffix array; equal strings are brought together exactly instead:

1. Every window of MATCH bytes is named by the least hash of its GRAM-byte
   strings. Equal windows have equal names, and neighbouring windows mostly
   share theirs, so a document is a list of runs (one per about 16 bytes).
   Each task sends the distinct names of its documents' groups, packed, to
   the name's bucket.
2. A bucket keeps the names that occur in more than one document and sends
   them back to the groups that hold them. A name of more than ``HOT_RUNS``
   different runs, by estimate, is hot (a common line of fewer than MATCH
   bytes in changing text): 1 and 2 are repeated for the windows under hot
   names, each named by the hash of all its MATCH bytes.
3. Each group's documents are cut again; the text under runs with such a name
   goes to the name's shard, window by window under a hot name. All windows
   that are equal meet in one shard. Of equal segments a group sends one, that
   of its least document (for every ``HELD_BYTES`` of segments); the copies in
   its other documents are removed whole and never sent.
4. A shard finds the least document of each distinct segment; a segment of
   another document is removed whole. Over the distinct segments of names that
   have several it builds an enhanced suffix array and scans its common-prefix
   intervals for maximal repeats (``lcp_intervals``); each occurrence whose
   document is not the least of its group is removed.
5. Spans return to their documents, are merged, and the rest is hashed.

Names, segments and spans travel as packed arrays, one row per task and
target. The number of groups, buckets and shards follows the text's total size
(``PART_BYTES`` each). A passage or a group of copies of any size adds a few
segments per group to a shard, not one per occurrence.

Defined cases: null text is empty; texts shorter than MATCH bytes are kept;
rows that share a doc_id (repeated rows too) are judged alike, none against
the other; a null doc_id counts as smaller than any; a very long text is cut
into runs like any other; there are no ties but those of shared doc_ids; an
empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import Workspace, doc_columns, slices, text_bytes, task
from .lcp_intervals import maximal_repeats
from .words import MIX

MATCH, GRAM = 50, 20
#: windows of one run that stay in one segment
RUN_WINDOWS = 64
PART_BYTES = 16 << 20
#: text bytes cut at once, names a task holds before it sends them, suffixes sorted at once
CUT_BYTES, HELD_NAMES, SUFFIXES = 1 << 20, 2_000_000, 200_000
#: text of segments a task holds before it sends each distinct one; different runs of a name that is still no hot name
HELD_BYTES, HOT_RUNS = 16 << 20, 25_000
LOWEST = np.iinfo(np.int64).min

_BYTE = np.random.default_rng(50).integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
POWER = 0x9E3779B97F4A7C15


def gram_hashes(data: np.ndarray, size: int = GRAM) -> np.ndarray:
    """Hash of the ``size`` bytes at every place, from hashes of doubled lengths."""
    h, width, total, done = _BYTE[data], 1, None, 0
    while width <= size:
        if size & width:              # strings of ``done`` bytes are followed by strings of ``width``
            if total is None:
                total, done = h, width
            else:
                n = len(h) - done
                total = total[:n] * np.uint64(pow(POWER, width, 1 << 64)) + h[done:done + n]
                done += width
        if 2 * width <= size:
            h = h[:-width] * np.uint64(pow(POWER, width, 1 << 64)) + h[width:]
        width *= 2
    total = total ^ (total >> np.uint64(32))
    total *= MIX[0]
    total ^= total >> np.uint64(29)
    return total


def sliding_least(h: np.ndarray, size: int) -> np.ndarray:
    width = 1
    while 2 * width <= size:
        h = np.minimum(h[:-width], h[width:])
        width *= 2
    rest = size - width
    return np.minimum(h[:len(h) - rest], h[rest:]) if rest else h


def runs(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(text number, name, first byte in ``data``, bytes) of every run of windows with one name."""
    none = np.zeros(0, np.int64)
    if len(data) < MATCH:
        return none, none.astype(np.uint64), none, none
    names = sliding_least(gram_hashes(data), MATCH - GRAM + 1)
    names &= ~np.uint64(1)            # the lowest bit is a mark in the names sent
    inside = np.zeros(len(names) + 1, np.int8)
    whole = np.diff(offsets) >= MATCH
    np.add.at(inside, offsets[:-1][whole], 1)
    np.add.at(inside, offsets[1:][whole] - MATCH + 1, -1)
    inside = np.cumsum(inside[:-1]) > 0
    begins = inside.copy()
    begins[1:] &= (names[1:] != names[:-1]) | ~inside[:-1]
    starts = offsets[:-1][whole]
    begins[starts] = True
    begin = np.flatnonzero(begins)
    ends = inside.copy()
    ends[:-1] &= begins[1:] | ~inside[1:]
    n = np.flatnonzero(ends) - begin + 1
    parts = -(-n // RUN_WINDOWS)
    run = np.repeat(np.arange(len(n)), parts)
    k = np.arange(parts.sum()) - np.repeat(np.cumsum(parts) - parts, parts)
    at = begin[run] + k * RUN_WINDOWS
    windows = np.minimum(n[run] - k * RUN_WINDOWS, RUN_WINDOWS)
    doc = np.searchsorted(offsets, at, side="right") - 1
    return doc, names[at], at, windows + MATCH - 1


def marked(names: np.ndarray) -> np.ndarray:
    return (names & np.uint64(1)).astype(bool)


def among(names: np.ndarray, sorted_names: np.ndarray) -> np.ndarray:
    if not len(sorted_names):
        return np.zeros(len(names), bool)
    place = np.searchsorted(sorted_names, names)
    place[place == len(sorted_names)] = 0
    return sorted_names[place] == names


def windows_under(data: np.ndarray, cut: tuple[np.ndarray, ...]) -> tuple[np.ndarray, ...]:
    """The runs ``cut`` window by window: as ``runs``, named by the hash of all MATCH bytes."""
    doc, _, at, n = cut
    if not len(doc):
        return cut
    count = n - MATCH + 1
    run = np.repeat(np.arange(len(n)), count)
    place = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count) + at[run]
    return doc[run], gram_hashes(data, MATCH)[place] & ~np.uint64(1), place, np.full(len(place), MATCH, np.int64)


def part_of(names: np.ndarray, parts: int) -> np.ndarray:
    return ((names >> np.uint64(20)) % np.uint64(parts)).astype(np.int64)


def split_by(key: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """(value, places) for each distinct value of ``key``."""
    order = np.argsort(key, kind="stable")
    cuts = np.flatnonzero(np.diff(key[order])) + 1
    for places in np.split(order, cuts):
        if len(places):
            yield int(key[places[0]]), places


def packed(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = list(zip(*rows)) or [()] * len(schema)
    arrays = [pa.array([x.tobytes() if isinstance(x, np.ndarray) else x for x in c], f.type)
              for c, f in zip(columns, schema)]
    return pa.RecordBatch.from_arrays(arrays, schema=schema)


def unpacked(column: pa.Array, dtype) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), dtype)


NAMES = pa.schema([("part", pa.int32()), ("groups", pa.binary()), ("names", pa.binary()), ("runs", pa.binary()),
                   ("signs", pa.binary())])


def send_names(rows: DataFrame, parts: int, hot: bool = False) -> DataFrame:
    """Step 1: (bucket, groups, their distinct names, their number of runs, a sign of one run's bytes).

    A name's lowest bit says: in several documents.

    With ``hot``: of the windows under hot names, for documents after the names wanted in their group.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, ...]] = []

        def flush() -> pa.RecordBatch:
            name, g, count, sign = (np.concatenate(x) for x in zip(*held))
            order = np.lexsort((g, name))
            name, g, count, sign = name[order], g[order], count[order], sign[order]
            new = np.concatenate([[True], (name[1:] != name[:-1]) | (g[1:] != g[:-1])])
            begin = np.flatnonzero(new)
            several = np.diff(np.append(begin, len(name))) > 1
            name, g, sign = name[new] | several.astype(np.uint64), g[new], sign[new]
            count = np.minimum(np.add.reduceat(count, begin), 65535)
            order = np.argsort(g, kind="stable")       # equal groups side by side compress well
            name, g, count, sign = name[order], g[order].astype(np.int32), count[order].astype(np.uint16), sign[order]
            return packed([(k, g[at], name[at], count[at], sign[at])
                           for k, at in split_by(part_of(name, parts))], NAMES)

        n = 0
        blobs: list[np.ndarray] = []
        chosen = None
        cut = side_first(batches, CUT_BYTES) if hot else ((b, None) for b in slices(batches, limit=CUT_BYTES))
        for batch, side in cut:
            if side is not None:
                blobs.append(unpacked(side.field("names"), np.uint64))
                continue
            data, offsets = text_bytes(batch.column("text"))
            found = runs(data, offsets)
            if hot:
                if chosen is None:
                    chosen = hot_names(blobs)
                if not len(chosen):
                    return
                here = among(found[1], chosen)
                found = windows_under(data, tuple(x[here] for x in found))
            doc, name, at, length = found
            if not len(doc):
                continue
            g = np.asarray(batch.column("g"))
            total = np.concatenate([[np.uint64(0)], np.cumsum(_BYTE[data])])
            sign = ((total[at + length] - total[at]) >> np.uint64(40)).astype(np.uint16)
            # each document's distinct names
            order = np.lexsort((name, doc))
            doc, name, sign = doc[order], name[order], sign[order]
            new = np.ones(len(doc), bool)
            new[1:] = (doc[1:] != doc[:-1]) | (name[1:] != name[:-1])
            count = np.diff(np.append(np.flatnonzero(new), len(doc)))
            held.append((name[new], g[doc[new]].astype(np.int64), count, sign[new]))
            n += len(count)
            if n >= HELD_NAMES:
                yield flush()
                held, n = [], 0
        if n:
            yield flush()

    return rows.mapInArrow(task(run), "part int, groups binary, names binary, runs binary, signs binary")


WANTED = pa.schema([("g", pa.int32()), ("n_hot", pa.int64()), ("names", pa.binary())])


def shared_names(sent: DataFrame, hot_runs: int | None) -> DataFrame:
    """Step 2: the names of a bucket that several documents have, for each group that holds them.

    The lowest bit says that a name is hot: it has more than ``hot_runs`` (if given) different runs, estimated from the
    share of different signs.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names, groups, runs_of, signs = [], [], [], []
        for batch in batches:
            names.append(unpacked(batch.column("names"), np.uint64))
            groups.append(unpacked(batch.column("groups"), np.int32).astype(np.int64))
            runs_of.append(unpacked(batch.column("runs"), np.uint16))
            signs.append(unpacked(batch.column("signs"), np.uint16))
        if not names:
            return
        name, g, count, sign = (np.concatenate(x) for x in (names, groups, runs_of, signs))
        several = marked(name)
        name = name & ~np.uint64(1)
        order = np.argsort(name, kind="stable")
        name, g, count, sign, several = name[order], g[order], count[order], sign[order], several[order]
        new = np.ones(len(name), bool)
        new[1:] = name[1:] != name[:-1]
        begin = np.flatnonzero(new)
        n = np.diff(np.append(begin, len(name)))
        wanted = np.repeat((n > 1) | np.logical_or.reduceat(several, begin), n)
        if hot_runs is not None:
            total = np.add.reduceat(count.astype(np.int64), begin)
            hot = total > hot_runs
            for k in np.flatnonzero(hot):
                different = len(np.unique(sign[begin[k]:begin[k] + n[k]]))
                hot[k] = total[k] * different > hot_runs * n[k]
            name = name | np.repeat(hot, n).astype(np.uint64)
        name, g = name[wanted], g[wanted]
        rows = ((k, np.unique(name[at])) for k, at in split_by(g))
        yield packed([(k, int(marked(x).sum()), x) for k, x in rows], WANTED)

    return sent.mapInArrow(task(run), "g int, n_hot long, names binary")


def hot_names(blobs: list[np.ndarray]) -> np.ndarray:
    names = np.unique(np.concatenate(blobs)) if blobs else np.zeros(0, np.uint64)
    return names[marked(names)] & ~np.uint64(1)


def by_group(docs: DataFrame, side: DataFrame, parts: int) -> DataFrame:
    """Documents after the side rows of their group: one partition per group, side rows first.

    The documents come in an order of their own values, so a document's number in its group is the same every time.
    """
    own = side.select("g", F.lit(0).alias("kind"), F.lit(None).cast("long").alias("doc_id"),
                      F.lit(None).cast("string").alias("text"), F.struct(*[c for c in side.columns if c != "g"])
                      .alias("side"))
    texts = docs.select("g", F.lit(1).alias("kind"), "doc_id", "text",
                        F.lit(None).cast(own.schema["side"].dataType).alias("side"))
    return own.unionByName(texts).repartitionById(parts, F.col("g")).sortWithinPartitions(
        "kind", "doc_id", "text")


def side_first(batches: Iterator[pa.RecordBatch], limit: int) -> Iterator[tuple[pa.RecordBatch, pa.Array | None]]:
    """(documents, None) slices after (no documents, side rows) ones, all of one group."""
    groups: set[int] = set()
    for batch in batches:
        groups.update(np.unique(np.asarray(batch.column("g"))).tolist())
        if len(groups) > 1:
            raise RuntimeError(f"a partition holds several groups: {sorted(groups)}")
        kind = np.asarray(batch.column("kind"))
        n = int(np.searchsorted(kind, 1))
        if n:
            yield batch, batch.slice(0, n).column("side")
        for part in slices(iter([batch.slice(n)]), limit=limit):
            yield part, None


#: distinct segments and their occurrences (``of``: number of the segment in this row); or spans without a segment
SEGMENTS = pa.schema([("part", pa.int32()), ("g", pa.int32()), ("names", pa.binary()), ("docs", pa.binary()),
                      ("lengths", pa.binary()), ("text", pa.binary()), ("of", pa.binary()), ("rows", pa.binary()),
                      ("starts", pa.binary()), ("ends", pa.binary())])


def texts_of(data: np.ndarray, lengths: np.ndarray) -> pa.Array:
    bounds = np.concatenate([[0], np.cumsum(lengths, dtype=np.int64)])
    return pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(lengths),
                                            [None, pa.py_buffer(bounds), pa.py_buffer(np.ascontiguousarray(data))])


def spread(first: np.ndarray, n: np.ndarray) -> np.ndarray:
    """The places first .. first + n - 1 of each range, one after the other."""
    return np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + np.repeat(first, n)


def distinct_segments(held: list[tuple[np.ndarray, ...]], g: int, parts: int) -> list[tuple]:
    """Rows for the shards: each distinct segment with its places in the group's least document, and the spans of
    its copies in other documents."""
    name, ids, row, start, n, data = (np.concatenate(x) for x in zip(*held))
    coded = texts_of(data, n).dictionary_encode()
    code = np.asarray(coded.indices, np.int64)
    count = len(coded.dictionary)
    least = np.full(count, np.iinfo(np.int64).max)
    np.minimum.at(least, code, ids)
    own = ids == least[code]
    out = []
    if not own.all():
        spans = merged(row[~own].astype(np.int64), start[~own], start[~own] + n[~own])
        out.append((g % parts, g, b"", b"", b"", b"", b"", *spans))
    names = np.zeros(count, np.uint64)
    names[code] = name
    texts, bounds = text_bytes(coded.dictionary)
    lengths = np.diff(bounds)
    places = np.flatnonzero(own)
    places = places[np.argsort(code[places], kind="stable")]
    first = np.searchsorted(code[places], np.arange(count + 1))
    for part, x in split_by(part_of(names, parts)):
        times = first[x + 1] - first[x]
        at = places[spread(first[x], times)]
        out.append((part, g, names[x], least[x], lengths[x].astype(np.uint16), texts[spread(bounds[x], lengths[x])],
                    np.repeat(np.arange(len(x), dtype=np.int32), times), row[at], start[at], b""))
    return out


def send_segments(rows: DataFrame, parts: int) -> DataFrame:
    """Step 3: the text under every run whose name is shared, for the name's shard."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        blobs: list[np.ndarray] = []
        held: list[tuple[np.ndarray, ...]] = []
        wanted, first_row, size, g = None, 0, 0, 0
        for batch, side in side_first(batches, CUT_BYTES):
            if side is not None:
                blobs.append(unpacked(side.field("names"), np.uint64))
                continue
            if wanted is None:
                hot = hot_names(blobs)
                wanted = np.unique(np.concatenate(blobs) & ~np.uint64(1)) if blobs else hot
                g = batch.column("g")[0].as_py()
            if not len(wanted):
                return
            data, offsets = text_bytes(batch.column("text"))
            found = runs(data, offsets)
            here = among(found[1], hot)
            if here.any():
                under = windows_under(data, tuple(x[here] for x in found))
                found = tuple(np.concatenate([x[~here], y]) for x, y in zip(found, under))
            keep = among(found[1], wanted)
            doc, name, at, n = (x[keep] for x in found)
            row = (doc + first_row).astype(np.int32)
            first_row += batch.num_rows
            if not len(doc):
                continue
            ids = np.asarray(batch.column("doc_id").fill_null(LOWEST))
            held.append((name, ids[doc], row, at - offsets[doc], n, data[spread(at, n)]))
            size += len(held[-1][-1])
            if size >= HELD_BYTES:
                yield packed(distinct_segments(held, g, parts), SEGMENTS)
                held, size = [], 0
        if held:
            yield packed(distinct_segments(held, g, parts), SEGMENTS)

    return rows.mapInArrow(task(run), "part int, g int, names binary, docs binary, lengths binary, text binary, "
                                      "of binary, rows binary, starts binary, ends binary")


def merged(doc: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Spans [start, end) per document (or segment), sorted, touching and overlapping ones joined."""
    if not len(doc):
        return doc, start, end
    order = np.lexsort((start, doc))
    doc, start, end = doc[order], start[order], end[order]
    number = np.cumsum(np.concatenate([[0], doc[1:] != doc[:-1]]))
    stride = int(end.max()) + 2
    reach = np.maximum.accumulate(end + number * stride)
    new = np.concatenate([[True], start[1:] + number[1:] * stride > reach[:-1]])
    begin = np.flatnonzero(new)
    last = np.append(begin[1:], len(doc)) - 1
    return doc[begin], start[begin], reach[last] - number[last] * stride


SPANS = pa.schema([("g", pa.int32()), ("rows", pa.binary()), ("starts", pa.binary()), ("ends", pa.binary())])


def covered(names: np.ndarray, docs: np.ndarray, texts: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(segment sent, first byte, end) of what is removed from the segments of a shard."""
    coded = texts.dictionary_encode()
    code, distinct = np.asarray(coded.indices, np.int64), coded.dictionary
    least = np.full(len(distinct), np.iinfo(np.int64).max)
    np.minimum.at(least, code, docs)
    data, bounds = text_bytes(distinct)
    lengths = np.diff(bounds)
    copies = np.flatnonzero(docs > least[code])
    yield copies, np.zeros(len(copies), np.int64), lengths[code[copies]]
    # distinct segments of names that have several of them
    name = np.zeros(len(distinct), np.uint64)
    name[code] = names
    order = np.argsort(name, kind="stable")
    new = np.concatenate([[True], name[order][1:] != name[order][:-1]])
    size = np.diff(np.append(np.flatnonzero(new), len(order)))
    order = order[np.repeat(size > 1, size)]
    if not len(order):
        return
    new = np.flatnonzero(np.concatenate([[True], name[order][1:] != name[order][:-1]]))
    count = np.cumsum(lengths[order] - MATCH + 1)
    # those sent from a segment's least document, by segment
    own = np.flatnonzero(docs == least[code])
    own = own[np.argsort(code[own], kind="stable")]
    first_own = np.searchsorted(code[own], np.arange(len(distinct) + 1))
    k = 0
    while k < len(new):
        done = count[new[k] - 1] if new[k] else 0
        z = max(k + 1, int(np.searchsorted(count[np.append(new[1:], len(order)) - 1], done + SUFFIXES)))
        chosen = order[new[k]:(new[z] if z < len(new) else len(order))]
        hits: list[tuple[np.ndarray, ...]] = []
        for depth, segment, offset in maximal_repeats(data, bounds[chosen], lengths[chosen], MATCH):
            owner = least[chosen[segment]]
            later = owner > owner.min()
            if later.any():
                hits.append((chosen[segment[later]], offset[later], offset[later] + depth))
        if hits:
            segment, start, end = merged(*(np.concatenate(x) for x in zip(*hits)))
            n = first_own[segment + 1] - first_own[segment]
            pick = np.repeat(np.arange(len(segment)), n)
            place = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + first_own[segment][pick]
            yield own[place], start[pick], end[pick]
        k = z


def removal_spans(segments: DataFrame) -> DataFrame:
    """Step 4: the merged removal spans of every document of a group that the shard has segments of."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = {"names": np.uint64, "docs": np.int64, "lengths": np.uint16, "text": np.uint8, "of": np.int32,
                 "rows": np.int32, "starts": np.int64}
        held: dict[str, list[np.ndarray]] = {k: [] for k in ("g", *kinds)}
        n = 0
        for batch in batches:
            for r in batch.to_pylist():
                if not r["names"]:
                    yield packed([(r["g"], r["rows"], r["starts"], r["ends"])], SPANS)
                    continue
                new = {k: np.frombuffer(r[k], t) for k, t in kinds.items()}
                new["of"] = new["of"].astype(np.int64) + n
                new["g"] = np.full(len(new["names"]), r["g"], np.int32)
                n += len(new["names"])
                for k, x in new.items():
                    held[k].append(x)
        if not n:
            return
        got = {k: np.concatenate(held.pop(k)) for k in list(held)}
        parts = list(covered(got["names"], got["docs"], texts_of(got["text"], got["lengths"])))
        which, start, end = (np.concatenate(x) for x in zip(*parts))
        # every place of a segment; they are in the order of the segments
        first = np.searchsorted(got["of"], np.arange(n + 1))
        times = first[which + 1] - first[which]
        at = spread(first[which], times)
        group, start, end = (np.repeat(x, times) for x in (got["g"][which].astype(np.int64), start, end))
        for g, x in split_by(group):
            base = got["starts"][at[x]]
            row = got["rows"][at[x]].astype(np.int64)
            yield packed([(g, *merged(row, base + start[x], base + end[x]))], SPANS)

    return segments.mapInArrow(task(run), "g int, rows binary, starts binary, ends binary")


SCHEMA = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string"


def cut_out(rows: DataFrame, keep_text: bool) -> DataFrame:
    """Step 5: every document without its spans."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        blobs: list[tuple[np.ndarray, ...]] = []
        spans, first_row = None, 0
        for batch, side in side_first(batches, CUT_BYTES):
            if side is not None:
                blobs.append(tuple(unpacked(side.field(k), np.int64) for k in ("rows", "starts", "ends")))
                continue
            if spans is None:
                empty = [tuple(np.zeros(0, np.int64) for _ in range(3))]
                spans = merged(*(np.concatenate(x) for x in zip(*(blobs or empty))))
            data, offsets = text_bytes(batch.column("text"))
            row = np.arange(first_row, first_row + batch.num_rows)
            first_row += batch.num_rows
            first, last = np.searchsorted(spans[0], row), np.searchsorted(spans[0], row, side="right")
            removed, digests, kept = [], [], []
            for k, (a, z) in enumerate(zip(first, last)):
                raw = data[offsets[k]:offsets[k + 1]].tobytes()
                edges = [0, *np.column_stack([spans[1][a:z], spans[2][a:z]]).ravel().tolist(), len(raw)]
                rest = b"".join(raw[x:y] for x, y in zip(edges[::2], edges[1::2]))
                removed.append(len(raw) - len(rest))
                digests.append(hashlib.sha256(rest).hexdigest())
                kept.append(rest)
            columns = [batch.column("doc_id"), pa.array(np.diff(offsets)), pa.array(removed, pa.int64()),
                       pa.array((last - first).astype(np.int64)), pa.array(digests, pa.string())]
            names = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"]
            if keep_text:
                columns.append(pa.array(kept, pa.binary()))
                names.append("kept")
            yield pa.RecordBatch.from_arrays(columns, names)

    return rows.mapInArrow(task(run), SCHEMA + (", kept binary" if keep_text else ""))


def remove_repeats(spark: SparkSession, docs: DataFrame, keep_text: bool = False) -> DataFrame:
    """Per document: its bytes, those removed, the removed runs and a digest of the rest (and the rest itself)."""
    work = Workspace(spark, "repeats")
    docs = doc_columns(docs)
    size = docs.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-size // PART_BYTES))
    grouped = docs.withColumn("g", F.pmod(F.xxhash64("doc_id"), F.lit(parts)).cast("int"))
    names = send_names(grouped, parts).repartitionById(parts, F.col("part"))
    wanted = work.stage(shared_names(names, HOT_RUNS), "names")
    hot = wanted.where("n_hot > 0")
    if not hot.isEmpty():
        names = send_names(by_group(grouped, hot, parts), parts, hot=True).repartitionById(parts, F.col("part"))
        wanted = wanted.unionByName(work.stage(shared_names(names, None), "hot-names"))
    segments = send_segments(by_group(grouped, wanted, parts), parts).repartitionById(parts, F.col("part"))
    spans = work.stage(removal_spans(segments), "spans")
    return cut_out(by_group(grouped, spans, parts), keep_text)
