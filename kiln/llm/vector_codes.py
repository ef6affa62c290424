"""Operator 13: vector code compression (product codes) with slice-and-intersect bitmasks.

Vectors become integers, are cut into parts, and each part is replaced by the index of its nearest codebook entry.
The nearest entry is found by boxes: per dimension the entries' coordinates are sorted, and a table holds for every
place in that order the mask of the entries before it. A part's distance to one seed entry gives the radius; two
searches per dimension give the slice of entries within the radius, ``before[high] & ~before[low]`` its mask, and
the masks of all dimensions are ANDed (uint64 words). The nearest entry and all its ties lie in that box, so exact
distances of the entries left decide, the lower index at a tie.

Codebooks are fitted on all rows: every round is one narrow pass over the written integers, in which a task sums its
rows by (part, entry) and Spark adds the tasks' sums. The driver holds the codebooks only (entries x dimensions), and
an executor lost in a round repeats that round's tasks.

Defined cases: rows whose vector is null or holds null or non-finite components are dropped, all others are kept,
repeated vec_ids and rows too; vectors shorter than the longest count as padded with zeros, and the last part is
padded where the length is no multiple of the number of parts; an empty vector is all zeros; a null vec_id is kept
and is no smallest one; starting entries of one vec_id are ordered by vector; with fewer rows than entries there are
as many entries as rows; integer components beyond +-2^25 (|x| over 8192) count as that bound, which keeps every
squared distance of up to 2,000 dimensions within 64 bits; an empty table gives an empty result; other columns are
ignored. There are no texts. All arithmetic is in integers, so results do not depend on partitions.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import Workspace, small_batches, task

PARTS, ENTRIES, ROUNDS, SCALE = 8, 16, 6, 4096
LIMIT = 1 << 25
#: rows coded at once inside a task
BLOCK = 16_384


class Codebook:
    """One part's entries, ready for box search."""

    def __init__(self, entries: np.ndarray):
        self.entries = entries
        k, width = entries.shape
        order = np.argsort(entries, axis=0, kind="stable").T                       # (width, k)
        self.coordinates = np.take_along_axis(entries.T, order, axis=1)
        words = -(-k // 64)
        bit = np.zeros((k, words), np.uint64)
        bit[np.arange(k), np.arange(k) // 64] = np.uint64(1) << (np.arange(k) % 64).astype(np.uint64)
        self.before = np.zeros((width, k + 1, words), np.uint64)
        self.before[:, 1:] = np.bitwise_or.accumulate(bit[order], axis=1)
        self.widest = int(np.argmax(self.coordinates[:, -1] - self.coordinates[:, 0]))
        self.by_widest = order[self.widest]

    def boxes(self, x: np.ndarray, radius: np.ndarray) -> np.ndarray:
        """Per row the mask (words of 64 bits) of the entries within ``radius`` of it in every dimension."""
        mask = np.full((len(x), self.before.shape[2]), ~np.uint64(0), np.uint64)
        for d, line in enumerate(self.coordinates):
            low = np.searchsorted(line, x[:, d] - radius, side="left")
            high = np.searchsorted(line, x[:, d] + radius, side="right")
            mask &= self.before[d, high] & ~self.before[d, low]
        return mask

    def nearest(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(index of the nearest entry, squared distance) of each row of ``x``."""
        at = np.searchsorted(self.coordinates[self.widest], x[:, self.widest])
        seed = self.by_widest[np.minimum(at, len(self.entries) - 1)]
        reach = np.square(x - self.entries[seed]).sum(axis=1)
        radius = np.sqrt(reach.astype(np.float64)).astype(np.int64) + 1             # never below the real one
        mask = self.boxes(x, radius)
        index, least = np.zeros(len(x), np.int64), np.full(len(x), np.iinfo(np.int64).max)
        for e, entry in enumerate(self.entries):                                    # ascending: ties stay low
            rows = np.flatnonzero(mask[:, e // 64] >> np.uint64(e % 64) & np.uint64(1))
            distance = np.square(x[rows] - entry).sum(axis=1)
            closer = distance < least[rows]
            index[rows[closer]], least[rows[closer]] = e, distance[closer]
        return index, least


def integer_vectors(embeddings: DataFrame, scale: int = SCALE) -> DataFrame:
    """vec_id, label and the integers floor(scale * x) of every whole vector."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            vectors = batch.column(2).cast(pa.large_list(pa.float64()))
            lengths = np.asarray(vectors.value_lengths().fill_null(0), np.int64)
            flat = vectors.flatten()
            values = np.asarray(flat.fill_null(np.nan), np.float64)
            row = np.repeat(np.arange(len(lengths)), lengths)
            keep = np.asarray(vectors.is_valid()).copy()
            keep[row[~np.isfinite(values)]] = False
            values = np.clip(np.floor(values[keep[row]] * scale), -LIMIT, LIMIT).astype(np.int32)
            offsets = np.concatenate([[0], np.cumsum(lengths[keep])]).astype(np.int32)
            kept = pa.array(np.flatnonzero(keep))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(kept), batch.column(1).take(kept),
                 pa.ListArray.from_arrays(pa.array(offsets), pa.array(values))], ["vec_id", "label", "v"])

    small_batches(embeddings.sparkSession)
    rows = embeddings.select(embeddings["vec_id"].cast("long").alias("vec_id"),
                             embeddings["label"].cast("long").alias("label"),
                             embeddings["embedding"].cast("array<double>").alias("embedding"))
    return rows.mapInArrow(task(run), "vec_id long, label long, v array<int>")


def _blocks(column: pa.Array, parts: int, width: int) -> Iterator[tuple[int, np.ndarray]]:
    """(first row, int64 array of rows x parts x width) of runs of vectors, padded with zeros."""
    for start in range(0, len(column), BLOCK):
        some = column.slice(start, BLOCK)
        lengths = np.asarray(some.value_lengths(), np.int64)
        x = np.zeros((len(some), parts * width), np.int64)
        x[np.arange(parts * width) < lengths[:, None]] = np.asarray(some.flatten(), np.int64)
        yield start, x.reshape(len(some), parts, width)


def _sums(vectors: DataFrame, books: np.ndarray) -> DataFrame:
    """(part, entry, n, s): per task and entry the number of parts assigned to it and their component sums."""
    parts, entries, width = books.shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        search = [Codebook(b) for b in books]
        n, s = np.zeros((parts, entries), np.int64), np.zeros((parts, entries, width), np.int64)
        for batch in batches:
            for _, x in _blocks(batch.column(0), parts, width):
                for p in range(parts):
                    index, _ = search[p].nearest(x[:, p])
                    n[p] += np.bincount(index, minlength=entries)
                    order = np.argsort(index, kind="stable")
                    used, first = np.unique(index[order], return_index=True)
                    s[p, used] += np.add.reduceat(x[order, p], first, axis=0)
        part, entry = np.nonzero(n)
        if len(part):
            yield pa.RecordBatch.from_arrays(
                [pa.array(part), pa.array(entry), pa.array(n[part, entry]),
                 pa.array(s[part, entry].tolist(), pa.list_(pa.int64()))], ["part", "entry", "n", "s"])

    return vectors.select("v").mapInArrow(task(run), "part long, entry long, n long, s array<long>")


def _moved(vectors: DataFrame, books: np.ndarray) -> np.ndarray:
    """The codebooks after one round: each used entry becomes the floored mean of its parts."""
    width = books.shape[2]
    wide = "decimal(38,0)"
    got = _sums(vectors, books).groupBy("part", "entry").agg(
        F.sum(F.col("n").cast(wide)).alias("n"),
        F.array(*[F.sum(F.get("s", F.lit(i)).cast(wide)) for i in range(width)]).alias("s")).collect()  # parts x entries
    out = books.copy()
    for r in got:
        out[r["part"], r["entry"]] = [int(x) // int(r["n"]) for x in r["s"]]
    return out


def first_codebooks(vectors: DataFrame, parts: int = PARTS, entries: int = ENTRIES) -> np.ndarray | None:
    """(parts, entries, width) from the rows with the smallest vec_ids; None for a table without rows."""
    longest = vectors.agg(F.max(F.size("v"))).first()[0]
    if longest is None:
        return None
    width = max(1, -(-longest // parts))
    rows = vectors.orderBy(F.col("vec_id").asc_nulls_last(), "v").limit(entries).select("v").collect()
    out = np.zeros((len(rows), parts * width), np.int64)
    for i, (v,) in enumerate(rows):
        out[i, :len(v)] = v
    return np.ascontiguousarray(out.reshape(len(rows), parts, width).transpose(1, 0, 2))


def fit_codebooks(vectors: DataFrame, parts: int = PARTS, entries: int = ENTRIES,
                  rounds: int = ROUNDS) -> np.ndarray | None:
    books = first_codebooks(vectors, parts, entries)
    for _ in range(rounds if books is not None else 0):
        books = _moved(vectors, books)
    return books


CODES = "vec_id long, label long, code binary, error long"


def encode(vectors: DataFrame, books: np.ndarray) -> DataFrame:
    """vec_id, label, code (one byte a part, two from the 257th entry on, big-endian) and squared error."""
    parts, entries, width = books.shape
    unit = np.dtype("u1" if entries <= 256 else ">u2")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        search = [Codebook(b) for b in books]
        for batch in batches:
            codes, errors = [], []
            for _, x in _blocks(batch.column(2), parts, width):
                found = [search[p].nearest(x[:, p]) for p in range(parts)]
                codes += [c.tobytes() for c in np.stack([i for i, _ in found], axis=1).astype(unit)]
                errors.append(sum(d for _, d in found))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(codes, pa.binary()),
                 pa.array(np.concatenate(errors) if errors else [], pa.int64())], ["vec_id", "label", "code", "error"])

    return vectors.mapInArrow(task(run), CODES)


def decode(code: bytes, books: np.ndarray) -> np.ndarray:
    """The integer vector that a code stands for."""
    unit = "u1" if books.shape[1] <= 256 else ">u2"
    return np.concatenate([books[p, e] for p, e in enumerate(np.frombuffer(code, unit))])


def vector_codes(spark: SparkSession, embeddings: DataFrame) -> DataFrame:
    """Per kept vector its code, error, the error of its label, and the digest of the codebooks."""
    work = Workspace(spark, "codes")
    vectors = work.stage(integer_vectors(embeddings), "integers")
    books = fit_codebooks(vectors)
    if books is None:
        return spark.createDataFrame([], "vec_id long, code string, error long, label_error long, "
                                         "codebooks_sha256 string")
    digest = hashlib.sha256(",".join(map(str, books.ravel().tolist())).encode()).hexdigest()
    coded = work.stage(encode(vectors, books), "codes")
    totals = coded.groupBy("label").agg(F.sum(F.col("error").cast("decimal(38,0)")).cast("long").alias("label_error"))
    both = coded.alias("c").join(totals.alias("t"), F.col("c.label").eqNullSafe(F.col("t.label")))
    return both.select("c.vec_id", F.lower(F.hex("c.code")).alias("code"), "c.error", "t.label_error",
                       F.lit(digest).alias("codebooks_sha256"))
