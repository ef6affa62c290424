"""Operator 3: quality by compression with zstandard dictionaries of good and of bad text.

Two raw-content dictionaries are cut from labelled text, one per class. A
document is compressed block by block with either; with sizes good and bad,
its feature is (bad - good) / (bad + good): text like the good sample becomes
smaller with the good dictionary. A logistic curve over that difference, its
square and its cube turns it into a probability of label 1; nothing else of a
text enters the score. The curve is cross-fitted: every labelled row's
difference comes from dictionaries of the other ``PARTS - 1`` parts of the
sample, so no row is judged by a dictionary that holds it.

Learning reads a bounded sample of whole texts: ``SAMPLE_DOCS`` documents per
class, by the smallest hash of doc_id among the rows that are not held out, and
at most ``SAMPLE_BYTES`` of text. Scoring reads whole texts, in one pass over the documents; the two
dictionaries (``DICTIONARY_BYTES`` each) are its only broadcast.

Defined cases: a null text is empty and gets the score of the sample's share
of label 1; a very long text is a slice of its own, compressed block by block;
a difference of 0 (a tie) gets what the curve gives there; repeated rows give
repeated rows; a document with several labels counts with its smallest; without
labelled rows of both classes every score is that share (0.5 with none); an
empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import doc_columns, slices, strings, task
from .labelled import fetch_sample, held_out, least_hashed

SAMPLE_DOCS, SAMPLE_BYTES, PARTS = 1_200, 64 << 20, 4
#: this level searches the dictionaries thoroughly enough for the difference alone to tell the classes apart
DICTIONARY_BYTES, BLOCK_BYTES, LEVEL = 112 << 10, 1 << 10, 12
FOLDS, FOLD = 3, 1


def pieces(raw: bytes) -> list[bytes]:
    return [raw[k:k + BLOCK_BYTES] for k in range(0, len(raw), BLOCK_BYTES)]


def build_dictionary(texts: list[bytes]) -> bytes:
    """An equal share of every text, most of it from evenly spaced places, joined to one dictionary."""
    share = max(64, DICTIONARY_BYTES // max(1, len(texts)))
    cuts = [t[max(0, len(t) // 2 - share // 2):][:share] for t in texts]
    return b"\n".join(cuts)[-DICTIONARY_BYTES:]


@dataclass(frozen=True)
class Model:
    good: bytes
    bad: bytes
    weights: tuple[float, ...]      # of (1, features); empty: every score is ``prior``
    prior: float

    def compressors(self):
        import zstandard as z
        return [z.ZstdCompressor(level=LEVEL, dict_data=z.ZstdCompressionDict(d, dict_type=z.DICT_TYPE_RAWCONTENT),
                                 write_content_size=False, write_dict_id=False).compress
                for d in (self.good, self.bad)]


def differences(texts: list[bytes], compressors) -> np.ndarray:
    """The normalised size difference of each text."""
    good, bad = compressors
    out = np.zeros(len(texts))
    for i, t in enumerate(texts):
        blocks = pieces(t) or [b""]
        a, b = sum(len(good(x)) for x in blocks), sum(len(bad(x)) for x in blocks)
        out[i] = (b - a) / (b + a)
    return out


def features(texts: list[bytes], compressors) -> np.ndarray:
    d = differences(texts, compressors)
    return np.column_stack([d, d**2, d**3])


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


def fit_logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1e-3, rounds: int = 50) -> np.ndarray:
    """Ridge logistic regression by Newton steps on standardised features; weights for raw features."""
    mean, scale = x.mean(0), x.std(0) + 1e-9
    z = np.column_stack([np.ones(len(x)), (x - mean) / scale])
    w = np.zeros(z.shape[1])
    penalty = ridge * len(x) * np.diag([0.0] + [1.0] * x.shape[1])
    for _ in range(rounds):
        p = sigmoid(z @ w)
        step = np.linalg.solve((z * (p * (1 - p))[:, None]).T @ z + penalty + 1e-9 * np.eye(len(w)),
                               z.T @ (y - p) - penalty @ w)
        w += step
        if np.abs(step).max() < 1e-8:
            break
    raw = w[1:] / scale
    return np.concatenate([[w[0] - raw @ mean], raw])


def learn(docs: DataFrame, labels: DataFrame) -> Model:
    """Dictionaries and curve from labelled documents that are not held out."""
    known = (labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("quality").cast("int").alias("quality"))
             .where(F.col("quality").isin(0, 1) & ~held_out(F.col("doc_id"), FOLDS, FOLD))
             .groupBy("doc_id").agg(F.min("quality").alias("quality")))
    counts = {r["quality"]: r["count"] for r in known.groupBy("quality").count().collect()}
    prior = counts.get(1, 0) / max(1, sum(counts.values())) if counts else 0.5
    if len(counts) < 2:
        return Model(b"", b"", (), prior)
    rows = fetch_sample(doc_columns(docs), least_hashed(known, "quality", SAMPLE_DOCS), ["doc_id"], SAMPLE_BYTES)
    rows = [r for r in rows if r["text"]]
    texts = {q: [r["text"].encode() for r in rows if r["quality"] == q] for q in (0, 1)}
    if min(map(len, texts.values())) < 4:
        return Model(b"", b"", (), prior)
    x = {0: [], 1: []}
    for part in range(PARTS):
        rest = [[t for i, t in enumerate(texts[q]) if i % PARTS != part] for q in (1, 0)]
        compressors = Model(*map(build_dictionary, rest), (), prior).compressors()
        for q in (0, 1):
            x[q].append(features(texts[q][part::PARTS], compressors))
    y = np.concatenate([np.full(sum(map(len, x[q])), float(q)) for q in (0, 1)])
    weights = tuple(fit_logistic(np.concatenate(x[0] + x[1]), y))
    return Model(build_dictionary(texts[1]), build_dictionary(texts[0]), weights, prior)


SCHEMA = "doc_id long, held_out boolean, score double, predicted int"


def quality_scores(docs: DataFrame, model: Model) -> DataFrame:
    """Per document: whether it is held out, its score (0 to 1) and the predicted label."""
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        compressors = m.compressors() if m.weights else None
        for batch in slices(batches):
            texts = [t.encode() for t in strings(batch.column(1)).to_pylist()]
            score = np.full(len(texts), m.prior)
            if compressors:
                some = np.array([bool(t) for t in texts])
                x = features(texts, compressors)
                score = np.where(some, sigmoid(m.weights[0] + x @ np.array(m.weights[1:])), m.prior)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(score)], ["doc_id", "score"])

    scored = doc_columns(docs).mapInArrow(task(run), "doc_id long, score double")
    return scored.select("doc_id", held_out(F.col("doc_id"), FOLDS, FOLD).alias("held_out"), "score",
                         (F.col("score") >= 0.5).cast("int").alias("predicted"))
