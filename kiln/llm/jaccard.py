"""Operator 1: n-gram Jaccard join with Bayesian pruning of MinHash candidates.

Two documents are linked when the sets of their runs of ``SHINGLE`` words
(``words.Words``) have a Jaccard similarity of at least ``THRESHOLD``; a text
of fewer words is one shingle of all of them.

1. Documents with equal shingle sets form a class; its representative is the
   one with the least doc_id. Copies are only counted from here on.
2. Candidates share a band of ``BAND`` of ``BANDS * BAND`` MinHash values: a
   pair at the threshold is missed with probability (1 - 0.8**5)**30 < 1e-5.
   A bucket's pairs compare their values ``STEP`` at a time and are dropped
   once the posterior probability (uniform prior) of reaching the threshold
   falls below ``TOLERANCE``. Each task keeps a spanning forest of the pairs
   that survive, never the pairs.
3. Within each component of survivors every pair is verified exactly, on the
   whole shingle sets, by matrix products; a task returns each member's links
   and again a spanning forest.

Buckets and components of any size are cut into chunks, and each pair of
chunks is a unit of work of bounded size, so a hot group spreads over tasks.
Sizes come from counts that are combined before the shuffle.

Result: one row per document with ``class_id`` (least doc_id of its connected
group), ``copy_of`` (least doc_id of its class) and ``n_links`` (other
documents it is linked to, copies included).

Defined cases: null text is empty; texts without words are linked to texts
equal to them only; repeated rows are copies of each other; rows that share a
doc_id are documents of their own, each with its own text's links; a null
doc_id represents nothing but gets its class; a very long text is a slice of
its own; a similarity of exactly the threshold links; an empty table gives an
empty result; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from fractions import Fraction
from math import comb

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import Workspace, doc_columns, slices, text_bytes, task
from .components import components
from .words import Words, mix

SHINGLE, THRESHOLD = 5, Fraction(4, 5)
BANDS, BAND, STEP, TOLERANCE = 30, 5, 10, 1e-6
HASHES = BANDS * BAND
#: members of a chunk of a bucket, and of a component
BUCKET_CHUNK, COMPONENT_CHUNK = 512, 256
#: values that one step of the signature loop holds, pairs compared at once, columns of a product
VALUES, PAIRS, COLUMNS = 1 << 15, 1 << 17, 4096
RUN = np.uint64(0x9DDFEA08EB382D69)

_draw = np.random.default_rng(20240229)
MULTIPLIERS = _draw.integers(0, 1 << 63, HASHES, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
SHIFTS = _draw.integers(0, 1 << 63, HASHES, dtype=np.uint64)


def shingle_sets(data: np.ndarray, offsets: np.ndarray, size: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """(document, 48-bit shingle) pairs, distinct and in order; for fewer than 2**16 documents."""
    words = Words(data, offsets)
    h, doc = words.hash, words.doc
    n = max(0, len(h) - size + 1)
    run = np.zeros(n, np.uint64)
    for k in range(size):
        run = run * RUN + h[k:k + n]
    whole = np.flatnonzero(doc[:n] == doc[size - 1:size - 1 + n])
    docs, values = [doc[whole]], [run[whole]]
    counts = np.diff(words.first)
    for d in np.flatnonzero((counts > 0) & (counts < size)):
        value = 0
        for x in h[words.first[d]:words.first[d + 1]].tolist():
            value = (value * int(RUN) + x) & ((1 << 64) - 1)
        docs.append(np.array([d]))
        values.append(np.array([value], np.uint64))
    doc, value = np.concatenate(docs).astype(np.uint64), mix(np.concatenate(values)) >> np.uint64(16)
    both = np.sort(doc << np.uint64(48) | value)
    if len(both):
        both = both[np.concatenate([[True], both[1:] != both[:-1]])]
    return (both >> np.uint64(48)).astype(np.int64), both & np.uint64((1 << 48) - 1)


def signatures(doc: np.ndarray, value: np.ndarray, n_docs: int) -> np.ndarray:
    """MinHash values of each document's set (rows of documents without a set are meaningless)."""
    out = np.zeros((n_docs, HASHES), np.uint32)
    begin = np.flatnonzero(np.concatenate([[True], doc[1:] != doc[:-1]])) if len(doc) else np.zeros(0, np.int64)
    k = 0
    while k < len(begin):
        z = max(k + 1, int(np.searchsorted(begin, begin[k] + VALUES)))
        stop = begin[z] if z < len(begin) else len(doc)
        part, cuts, rows = value[begin[k]:stop], begin[k:z] - begin[k], doc[begin[k:z]]
        room = np.empty_like(part)
        for j in range(HASHES):
            np.multiply(part, MULTIPLIERS[j], out=room)
            room += SHIFTS[j]
            out[rows, j] = np.minimum.reduceat(room, cuts) >> np.uint64(32)
        k = z
    return out


SKETCH = "doc_id long, tid string, k1 long, k2 long, n long, sig binary"


def with_tid(docs: DataFrame) -> DataFrame:
    return docs.withColumn("tid", F.md5(F.coalesce("text", F.lit("")).cast("binary")))


def sketch(docs: DataFrame) -> DataFrame:
    """Per document: its text's identity, a 128-bit key and the size of its shingle set, and its MinHash values."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            data, offsets = text_bytes(batch.column(1))
            rows = len(offsets) - 1
            doc, value = shingle_sets(data, offsets)
            n = np.bincount(doc, minlength=rows)
            keys = np.zeros((2, rows), np.uint64)
            for key, salt in zip(keys, (1, 2)):
                np.add.at(key, doc, mix(value * np.uint64(4) + np.uint64(salt)))
            for i in np.flatnonzero(n == 0):
                text = data[offsets[i]:offsets[i + 1]].tobytes()
                keys[:, i] = np.frombuffer(hashlib.blake2b(text, digest_size=16).digest(), np.uint64)
            sig = signatures(doc, value, rows)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(2), pa.array(keys[0].view(np.int64)), pa.array(keys[1].view(np.int64)),
                 pa.array(n), pa.array([s.tobytes() if m else None for s, m in zip(sig, n)], pa.binary())],
                ["doc_id", "tid", "k1", "k2", "n", "sig"])

    return with_tid(doc_columns(docs)).mapInArrow(task(run), SKETCH)


def sig_matrix(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint32).reshape(-1, HASHES)


def band_keys(classes: DataFrame) -> DataFrame:
    """(key, rep) for every band of every class."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sig = sig_matrix(batch.column(1)).reshape(-1, BANDS, BAND).astype(np.uint64)
            key = np.broadcast_to(np.arange(1, BANDS + 1, dtype=np.uint64), sig.shape[:2])
            for j in range(BAND):
                key = mix(key * RUN + sig[:, :, j])
            rep = np.repeat(np.asarray(batch.column(0)), BANDS)
            yield pa.RecordBatch.from_arrays([pa.array(key.ravel().view(np.int64)), pa.array(rep)], ["key", "rep"])

    return classes.select("rep", "sig").mapInArrow(task(run), "key long, rep long")


def in_chunks(members: DataFrame, key: str, count: str, chunk: int) -> DataFrame:
    """Each member of a group once per pair of chunks (i <= j) that its chunk ``c`` takes part in."""
    n = F.ceil(F.col(count) / chunk).cast("int")
    c = F.pmod(F.xxhash64("rep"), n).cast("int")
    return (members.withColumn("c", c).withColumn("other", F.explode(F.sequence(F.lit(0), n - 1)))
            .withColumn("i", F.least("c", "other")).withColumn("j", F.greatest("c", "other"))
            .drop("other", count))


def unit_groups(batches: Iterator[pa.RecordBatch], key: str) -> Iterator[pa.RecordBatch]:
    """Batches of whole (key, i, j) groups, from rows sorted by them; the last group waits for the next batch."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        held.append(batch)
        names = [np.asarray(batch.column(x)) for x in (key, "i", "j")]
        change = np.flatnonzero(np.logical_or.reduce([x[1:] != x[:-1] for x in names])) + 1
        first = [np.asarray(held[0].column(x))[0] == n[0] for x, n in zip((key, "i", "j"), names)]
        if len(held) > 1 and not all(first):       # the batch begins a new group
            yield pa.concat_batches(held[:-1])
            held = [batch]
        if len(change):
            cut = int(change[-1])
            yield pa.concat_batches([*held[:-1], batch.slice(0, cut)])
            held = [batch.slice(cut)]
    if held:
        yield pa.concat_batches(held)


def group_bounds(batch: pa.RecordBatch, key: str) -> np.ndarray:
    names = [np.asarray(batch.column(x)) for x in (key, "i", "j")]
    change = np.flatnonzero(np.logical_or.reduce([x[1:] != x[:-1] for x in names])) + 1
    return np.concatenate([[0], change, [batch.num_rows]])


def least_matches(threshold: float = float(THRESHOLD), tolerance: float = TOLERANCE) -> np.ndarray:
    """For n = 0..HASHES values compared: the least number of matches that keeps a pair.

    With a uniform prior the posterior after m matches in n is Beta(m + 1, n - m + 1), whose upper tail at the
    threshold is the chance of at most m successes in n + 1 trials.
    """
    out = np.zeros(HASHES + 1, np.int64)
    for n in range(1, HASHES + 1):
        tail, m = 0.0, -1
        while tail < tolerance:
            m += 1
            tail += comb(n + 1, m) * threshold**m * (1 - threshold)**(n + 1 - m)
        out[n] = m
    return out


def surviving(sig: np.ndarray, a: np.ndarray, b: np.ndarray, least: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The pairs (rows of ``sig``) that no step drops."""
    matches = np.zeros(len(a), np.int64)
    for k in range(0, HASHES, STEP):
        matches += (sig[a, k:k + STEP] == sig[b, k:k + STEP]).sum(1)
        keep = matches >= least[k + STEP]
        a, b, matches = a[keep], b[keep], matches[keep]
    return a, b


def forest(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """For each of n nodes, the least node it is connected to by the edges (a, b)."""
    label = np.arange(n)
    while len(a):
        low = np.minimum(label[a], label[b])
        np.minimum.at(label, label[a], low)
        np.minimum.at(label, label[b], low)
        label = label[label]
        apart = label[a] != label[b]
        a, b = a[apart], b[apart]
    while (label != label[label]).any():
        label = label[label]
    return label


def chunk_pairs(i: int, j: int, chunk: np.ndarray, base: int) -> tuple[np.ndarray, np.ndarray]:
    """The pairs of one unit: within a chunk each pair once, else every pair across the two."""
    if i == j:
        a, b = np.triu_indices(len(chunk), 1)
        return a + base, b + base
    left, right = np.flatnonzero(chunk == i) + base, np.flatnonzero(chunk == j) + base
    return np.repeat(left, len(right)), np.tile(right, len(left))


def candidate_forest(units: DataFrame) -> DataFrame:
    """Edges (a, b) that span what Bayesian pruning leaves of every bucket."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        least = least_matches()
        for batch in unit_groups(batches, "key"):
            sig = sig_matrix(batch.column("sig"))
            rep, c = np.asarray(batch.column("rep")), np.asarray(batch.column("c"))
            i, j = np.asarray(batch.column("i")), np.asarray(batch.column("j"))
            bounds = group_bounds(batch, "key")
            label = np.arange(len(rep))
            waiting, n = [], 0
            for g, (lo, hi) in enumerate(zip(bounds[:-1], bounds[1:])):
                waiting.append(chunk_pairs(i[lo], j[lo], c[lo:hi], lo))
                n += len(waiting[-1][0])
                if n >= PAIRS or g == len(bounds) - 2:
                    a, b = (np.concatenate(x) for x in zip(*waiting))
                    kept = [surviving(sig, a[k:k + PAIRS], b[k:k + PAIRS], least) for k in range(0, len(a), PAIRS)]
                    if kept:
                        a, b = (np.concatenate(x) for x in zip(*kept))
                        label = np.minimum(label, forest(len(rep), a, b))  # groups share no rows
                    waiting, n = [], 0
            moved = np.flatnonzero(label != np.arange(len(rep)))
            edges = np.unique(np.column_stack([rep[moved], rep[label[moved]]]), axis=0)
            yield pa.RecordBatch.from_arrays([pa.array(edges[:, 0]), pa.array(edges[:, 1])], ["a", "b"])

    return units.mapInArrow(task(run), "a long, b long")


def shared_shingles(sets: list[np.ndarray]) -> np.ndarray:
    """How many shingles each two sets share, by products of presence matrices over the shingles of two or more."""
    owner = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    distinct, code, count = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    column = np.cumsum(count > 1) - 1
    common = count[code] > 1
    owner, code = owner[common], column[code[common]]
    order = np.argsort(code, kind="stable")
    owner, code = owner[order], code[order]
    out = np.zeros((len(sets), len(sets)), np.float32)
    width = int(code[-1]) + 1 if len(code) else 0
    for k in range(0, width, COLUMNS):
        lo, hi = np.searchsorted(code, [k, k + COLUMNS])
        present = np.zeros((len(sets), min(COLUMNS, width - k)), np.float32)
        present[owner[lo:hi], code[lo:hi] - k] = 1
        out += present @ present.T
    return out


def verify(units: DataFrame) -> DataFrame:
    """Per member and unit: the documents it is linked to there, and the least member it is connected to."""
    p, q = THRESHOLD.numerator, THRESHOLD.denominator

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in unit_groups(batches, "comp"):
            rep, c = np.asarray(batch.column("rep")), np.asarray(batch.column("c"))
            i, j = np.asarray(batch.column("i")), np.asarray(batch.column("j"))
            weight = np.asarray(batch.column("size"))
            raw = batch.column("set").to_pylist()
            bounds = group_bounds(batch, "comp")
            links, parent = np.zeros(len(rep), np.int64), rep.copy()
            for lo, hi in zip(bounds[:-1], bounds[1:]):
                sets = [np.frombuffer(x, np.int64) for x in raw[lo:hi]]
                sizes = np.array([len(s) for s in sets])
                both = shared_shingles(sets)
                # shared / (sum - shared) >= p / q
                linked = (p + q) * both >= p * (sizes[:, None] + sizes[None, :])
                linked &= rep[lo:hi, None] != rep[None, lo:hi]
                if i[lo] != j[lo]:
                    linked &= c[lo:hi, None] != c[None, lo:hi]
                links[lo:hi] = linked @ weight[lo:hi]
                label = forest(hi - lo, *np.nonzero(np.triu(linked)))
                parent[lo:hi] = rep[lo:hi][label]
            yield pa.RecordBatch.from_arrays([pa.array(rep), pa.array(links), pa.array(parent)],
                                             ["rep", "links", "parent"])

    return units.mapInArrow(task(run), "rep long, links long, parent long")


def whole_sets(members: DataFrame) -> DataFrame:
    """``members`` (rep, comp, count, size, text) with the text replaced by its shingle set."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            data, offsets = text_bytes(batch.column("text"))
            doc, value = shingle_sets(data, offsets)
            cuts = np.searchsorted(doc, np.arange(batch.num_rows + 1))
            value = value.astype(np.int64)
            sets = pa.array([value[a:z].tobytes() for a, z in zip(cuts[:-1], cuts[1:])], pa.binary())
            yield pa.RecordBatch.from_arrays([*(batch.column(x) for x in ("rep", "comp", "count", "size")), sets],
                                             ["rep", "comp", "count", "size", "set"])

    return members.select("rep", "comp", "count", "size", "text").mapInArrow(
        task(run), "rep long, comp long, count long, size long, set binary")


def by_units(members: DataFrame, key: str, count: str, chunk: int) -> DataFrame:
    return in_chunks(members, key, count, chunk).repartition(key, "i", "j").sortWithinPartitions(key, "i", "j")


def grouped(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, tid, class_id, copy_of, n_links, and ``component`` (NULL: its class alone)."""
    work = Workspace(spark, "jaccard")
    docs = doc_columns(docs)
    keys = ["k1", "k2", "n"]
    sketches = work.stage(sketch(docs), "sketches")
    # a class is known by a number of its own, not by a doc_id, which other texts may share
    classes = work.stage(sketches.groupBy(*keys).agg(
        F.min("doc_id").alias("first_id"), F.count("*").alias("size"), F.first("sig").alias("sig"),
        F.min("tid").alias("tid")).withColumn("rep", F.monotonically_increasing_id()), "classes")
    graph = classes.where((F.col("n") > 0) & F.col("first_id").isNotNull())

    bands = work.stage(band_keys(graph), "bands")
    hot = bands.groupBy("key").agg(F.count("*").alias("count")).where("count > 1")
    buckets = work.stage(bands.join(hot, "key"), "buckets")
    units = by_units(buckets.join(graph.select("rep", "sig"), "rep"), "key", "count", BUCKET_CHUNK)
    rough = components(work, candidate_forest(units), "rough").select(F.col("node").alias("rep"),
                                                                     F.col("label").alias("comp"))

    sizes = rough.groupBy("comp").agg(F.count("*").alias("count"))
    texts = with_tid(docs).select("tid", "text").dropDuplicates(["tid"])
    members = (rough.join(sizes, "comp").join(graph.select("rep", "size", "tid"), "rep").join(texts, "tid"))
    checked = work.stage(verify(by_units(whole_sets(members), "comp", "count", COMPONENT_CHUNK)), "checked")
    groups = components(work, checked.select(F.col("rep").alias("a"), F.col("parent").alias("b")), "groups").select(
        F.col("node").alias("rep"), F.col("label").alias("component"))

    least = (groups.join(classes.select("rep", "first_id"), "rep").groupBy("component")
             .agg(F.min("first_id").alias("class_id")))
    links = checked.groupBy("rep").agg(F.sum("links").alias("links"))
    named = work.stage(classes.select(*keys, "rep", "first_id", "size").join(groups.join(least, "component"), "rep", "left")
                       .join(links, "rep", "left"), "named")
    return sketches.select("doc_id", "tid", *keys).join(named, keys).select(
        "doc_id", "tid", F.coalesce("class_id", "first_id").alias("class_id"), F.col("first_id").alias("copy_of"),
        (F.col("size") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"),
        F.coalesce("component", "rep").alias("component"))


def jaccard_join(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, class_id, copy_of, n_links."""
    return grouped(spark, docs).select("doc_id", "class_id", "copy_of", "n_links")


def one_of_each(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """``docs`` with one row of each connected group, that of the least doc_id and then text; columns are kept.

    A row without doc_id comes after all others: it is kept where its group has no document with an id. Rows that
    share a doc_id are documents of their own.
    """
    unnamed = F.lit(1 << 62) + F.xxhash64("text").bitwiseAND(F.lit((1 << 60) - 1))
    key, tid = "near_duplicate_key", "near_duplicate_text"
    while key in docs.columns or tid in docs.columns:
        key, tid = key + "_", tid + "_"
    rows = docs.withColumn(key, F.coalesce(F.col("doc_id").cast("long"), unnamed)).withColumn(
        tid, F.md5(F.coalesce(F.col("text").cast("string"), F.lit("")).cast("binary")))
    groups = grouped(spark, rows.select(F.col(key).alias("doc_id"), "text"))
    kept = groups.groupBy("component").agg(F.min(F.struct("doc_id", "tid")).alias("first")).select(
        F.col("first.doc_id").alias(key), F.col("first.tid").alias(tid))
    return rows.join(kept, [key, tid], "left_semi").dropDuplicates([key, tid]).drop(key, tid)
