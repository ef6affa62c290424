"""Operator 8: document fingerprints by consistent weighted sampling.

A document's terms are its words (``words.Words``), weighted by their counts;
a text without words is one term of weight 1, the whole text. For every term
and sample the method draws r, c from Gamma(2, 1) and b from (0, 1), all from
the term's hash, takes t = floor(ln(weight) / r + b) and keeps the term with
the least ln c - r (t - b) - r. That value depends on the weight through t
alone, so two documents share a sample exactly where they share its term and
t, which happens with the probability of their generalised Jaccard similarity
(sum of least weights over sum of greatest). A fingerprint holds a name of 16
bits of each of ``SAMPLES`` kept (term, t) as hex; names are integers from
hashes, so a last digit of a logarithm cannot change them. The likeness of two
fingerprints is the share of equal samples.

``edited_fingerprints`` needs each document's successor: shards are ranges of
doc_id, sorted within; each shard also receives the first document of the
next one. One shuffle of the texts; the driver only sees shard borders. A text
and its edited form are drawn together, so terms they share are drawn once.

Defined cases: null text is empty; equal texts have equal fingerprints, empty
ones too; terms of equal value keep the smaller name; a very long text is a
slice of its own; repeated doc_ids follow each other in text order, and so may
be each other's next document; a single document follows itself; an empty
table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import doc_columns, slices, strings, task, text_bytes
from .words import Words, mix

SAMPLES = 128
#: text bytes fingerprinted at once: (term, weight) pairs are drawn once per slice
TEXT_SLICE = 4 << 20
#: text bytes of a shard, about
SHARD_BYTES = 64 << 20
#: rows of the (term, weight) table and of gathered terms that are held at once
BLOCK = 4_096
# one odd stream constant per 64 hashed bits (fixed values)
STREAMS = tuple(np.uint64(x) for x in (0xD1342543DE82EF95, 0xA24BAED4963EE407))


def _streams(terms: np.ndarray, stream: np.uint64) -> np.ndarray:
    """64 hashed bits for each term (rows) and sample (columns)."""
    steps = (np.arange(1, SAMPLES + 1, dtype=np.uint64) * stream)[None, :]
    return mix(terms[:, None] + steps)


def _uniform(h: np.ndarray, shift: int, bits: int) -> np.ndarray:
    """A draw from (0, 1) of ``bits`` bits of the hash."""
    part = (h >> np.uint64(shift)) & np.uint64((1 << bits) - 1)
    return part.astype(np.float32) * np.float32(2.0**-bits) + np.float32(2.0**(-bits - 1))


def sample_values(terms: np.ndarray, weights: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(value, name) that each (term, weight) enters each sample with.

    The value decides which term a sample keeps; the name, 16 bits that depend on the term and t alone, is what the
    fingerprint holds of it. Both come from hashes: two draws of 32 bits for r, two of 20 and 23 for c, 20 for b.
    """
    h = _streams(terms, STREAMS[0])
    r = -np.log(_uniform(h, 0, 32) * _uniform(h, 32, 32))
    h = _streams(terms, STREAMS[1])
    ln_c = np.log(-np.log(_uniform(h, 0, 23) * _uniform(h, 23, 20)))
    shift = _uniform(h, 43, 20)
    t = np.floor(np.log(weights.astype(np.float32))[:, None] / r + shift)
    name = (h * STREAMS[0] >> np.uint64(48)).astype(np.uint16) + t.astype(np.int32).astype(np.uint16) * np.uint16(0x9E37)
    return ln_c - r * (t - shift) - r, name


def _ordered(values: np.ndarray) -> np.ndarray:
    """Unsigned integers in the order of the float32 values."""
    bits = values.view(np.uint32)
    sign = np.uint32(1 << 31)
    return np.where(bits & sign, ~bits, bits | sign)


def signatures(column: pa.Array) -> np.ndarray:
    """One row of ``SAMPLES`` 16-bit values per text."""
    data, offsets = text_bytes(column)
    n = len(offsets) - 1
    words = Words(data, offsets)
    docs, terms = words.doc, words.hash
    bare = np.flatnonzero(np.diff(words.first) == 0)
    if len(bare):
        whole = [hashlib.blake2b(data[offsets[i]:offsets[i + 1]].tobytes(), digest_size=8).digest() for i in bare]
        docs = np.concatenate([docs, bare])
        terms = np.concatenate([terms, np.frombuffer(b"".join(whole), np.uint64)])
    distinct, code = np.unique(terms, return_inverse=True)
    key, weight = np.unique(docs * len(distinct) + code, return_counts=True)
    doc, code = np.divmod(key, max(1, len(distinct)))
    # each distinct (term, weight) is drawn once per call
    pair, row = np.unique(code * (weight.max(initial=1) + 1) + weight, return_inverse=True)
    pair_code, pair_weight = np.divmod(pair, weight.max(initial=1) + 1)
    table = np.empty((len(pair), SAMPLES), np.uint64)             # the value above, the name in the low 16 bits
    for k in range(0, len(pair), BLOCK):
        v, name = sample_values(distinct[pair_code[k:k + BLOCK]], pair_weight[k:k + BLOCK])
        np.left_shift(_ordered(v), np.uint64(16), out=table[k:k + BLOCK], dtype=np.uint64)
        table[k:k + BLOCK] |= name
    least = np.full((n, SAMPLES), np.iinfo(np.uint64).max, np.uint64)
    for k in range(0, len(row), BLOCK):
        d, some = doc[k:k + BLOCK], row[k:k + BLOCK]
        begin = np.flatnonzero(np.concatenate([[True], d[1:] != d[:-1]]))
        at = d[begin]
        least[at] = np.minimum(least[at], np.minimum.reduceat(table[some], begin, axis=0))
    return least.astype("<u2")


def likeness(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return (a == b).mean(axis=1)


def to_hex(rows: np.ndarray) -> list[str]:
    return [r.tobytes().hex() for r in rows]


def fingerprints(docs: DataFrame) -> DataFrame:
    """Per document: doc_id and fingerprint."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, limit=TEXT_SLICE):
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(to_hex(signatures(batch.column(1))))],
                                             ["doc_id", "fingerprint"])

    return doc_columns(docs).mapInArrow(task(run), "doc_id long, fingerprint string")


def _sharded(docs: DataFrame, shards: int) -> DataFrame:
    """The documents by ranges of doc_id, each shard followed by the first document of the next (tail = 1)."""
    borders = docs.approxQuantile("doc_id", [k / shards for k in range(1, shards)], 0.25 / shards) if shards > 1 else []
    borders = np.array(sorted(set(borders)), np.int64)

    @F.pandas_udf("long")
    def shard_of(doc_id: pd.Series) -> pd.Series:
        ids = doc_id.fillna(np.iinfo(np.int64).min).astype("int64")
        return pd.Series(np.searchsorted(borders, ids.to_numpy(), side="right"))

    order = Window.orderBy("shard")  # one row per shard
    first = docs.select("doc_id").withColumn("shard", shard_of("doc_id")).groupBy("shard").agg(
        F.min(F.struct(F.col("doc_id").isNotNull().alias("known"), "doc_id")).alias("first"))
    lowest = F.first("first.doc_id").over(order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    last = F.row_number().over(Window.orderBy(F.desc("shard"))) == 1
    follow = first.select("shard", F.when(last, lowest).otherwise(F.lead("first.doc_id").over(order)).alias("next_id"))
    # at most one row per shard: bounded by the shard count, whatever the input
    heads = docs.join(F.broadcast(follow), docs["doc_id"].eqNullSafe(follow["next_id"])).groupBy("shard").agg(
        F.min("text").alias("text"))
    return (docs.withColumn("shard", shard_of("doc_id")).withColumn("tail", F.lit(0))
            .unionByName(heads.select(F.lit(None).cast("long").alias("doc_id"), "text", "shard",
                                      F.lit(1).alias("tail"))))


EDITED = ("doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
          "near_edited double, near_next double")


def edited_fingerprints(docs: DataFrame) -> DataFrame:
    """Fingerprints of each document and of its edited text, and their likeness to each other and to the next one's.

    Edited: the last quarter of the code points (rounded down) replaced by as many first ones of the next document.
    """
    docs = doc_columns(docs).withColumn("text", F.coalesce("text", F.lit("")))
    size = docs.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    shards = max(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-size // SHARD_BYTES))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: pa.RecordBatch | None = None  # the row before the slice, whose next document the slice begins with
        for batch in slices(batches, limit=TEXT_SLICE):
            held, rows = batch.slice(batch.num_rows - 1, 1), (
                batch if held is None else pa.concat_batches([held, batch]))
            shard = np.asarray(rows.column("shard"))
            tail = np.asarray(rows.column("tail"))
            own = (tail[:-1] == 0) & (shard[:-1] == shard[1:])  # a tail, and so a shard's last row, has no next
            if not own.any():
                continue
            texts = rows.column("text").to_pylist()
            at = np.flatnonzero(own)
            edited = [texts[i][:len(texts[i]) - len(texts[i]) // 4] + texts[i + 1][:len(texts[i]) // 4] for i in at]
            # one call: a text and its edited form share nearly all their terms
            both = signatures(pa.concat_arrays([strings(rows.column("text")), pa.array(edited, pa.large_string())]))
            sig, changed = both[:len(texts)], both[len(texts):]
            yield pa.RecordBatch.from_arrays(
                [rows.column("doc_id").take(pa.array(at)), pa.array([len(texts[i]) for i in at], pa.int64()),
                 pa.array([hashlib.sha256(x.encode()).hexdigest() for x in edited]), pa.array(to_hex(sig[at])),
                 pa.array(to_hex(changed)), pa.array(likeness(sig[at], changed)),
                 pa.array(likeness(sig[at], sig[at + 1]))],
                ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited",
                 "near_next"])

    parts = _sharded(docs, shards).repartitionById(shards, F.col("shard").cast("int"))
    ordered = parts.sortWithinPartitions("shard", "tail", F.col("doc_id").asc_nulls_first(), "text")
    return ordered.mapInArrow(task(run), EDITED)
