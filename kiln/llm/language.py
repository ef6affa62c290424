"""Operator 4: language by string kernels, Nystroem landmarks and one-versus-rest kernel ridge regression.

The kernel is the blended-spectrum presence kernel: over the byte n-grams
(n = 1, 2, 3) of the lower-cased text, the number of distinct n-grams that two
texts share, divided by the root of the product of their numbers. ``landmarks``
training texts span the Nystroem space (kernel to the landmarks times the
inverse root of the landmarks' own kernel matrix); a ridge regression there,
one target per language, gives the scores. Scoring a slice is a presence
matrix and two matrix products. Trigrams are counted in ``TRIGRAM_BITS``-bit
hash cells, monograms and bigrams in cells of their own.

Learning reads a bounded sample of whole texts: ``SAMPLE_DOCS`` documents per
language by the smallest hash of doc_id among the rows that are not held out
and at most ``SAMPLE_BYTES`` of text. ``LANDMARKS`` per language are landmarks,
``MAX_LANDMARKS`` in all. Every label is learned: one ranking over narrow rows
serves all of them. Scoring reads whole texts in one pass; the model, the only
broadcast, grows with the number of languages, not with the documents.

Score: the softmax of the regression's outputs at ``SHARPNESS``.

Defined cases: a null text or one without a letter is ``und`` with score 0;
without any learned language every text is ``und``; a single learned language
is predicted with score 1; ties go to the language that sorts first; a very
long text is a slice of its own; repeated rows give repeated rows and count
once in the sample; an empty table gives an empty result; other columns are
ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import doc_columns, slices, small_batches, task, text_bytes
from .labelled import fetch_sample, held_out, least_hashed

FOLDS, FOLD = 4, 2
#: documents a language and text bytes of all languages that are learned from; landmarks of a language, and of all
SAMPLE_DOCS, SAMPLE_BYTES, LANDMARKS, MAX_LANDMARKS = 300, 64 << 20, 40, 800
#: share of all documents that may be learned from whose score is well above the least one that ``keep_languages`` accepts
CLEAN = 0.998
#: scores are counted in steps of this share when that least score is looked for
SCORE_STEPS = 10_000
RIDGE, SHARPNESS = 1e-2, 6.0
TRIGRAM_BITS = 15
CELLS = 256 + (1 << 16) + (1 << TRIGRAM_BITS)
#: documents whose presence matrix is held at once
ROWS = 256
UND = "und"


def presence(column: pa.Array) -> Iterator[tuple[int, np.ndarray]]:
    """(first row, presence matrix of up to ``ROWS`` texts): 1 where a text holds a cell's n-gram."""
    data, offsets = text_bytes(column)
    data = np.frombuffer(data.tobytes().lower(), np.uint8)
    for first in range(0, len(offsets) - 1, ROWS):
        last = min(first + ROWS, len(offsets) - 1)
        a, z = offsets[first], offsets[last]
        b = data[a:z].astype(np.uint32)
        ends = offsets[first:last + 1] - a
        lens = np.diff(ends)
        row = np.repeat(np.arange(last - first, dtype=np.int64) * CELLS, lens)
        out = np.zeros((last - first) * CELLS, np.uint8)
        out[row + b] = 1
        if len(b) > 1:
            two = row[:-1] + 256 + (b[:-1] << np.uint32(8) | b[1:])
            inner = row[:-1] == row[1:]
            out[two[inner]] = 1
        if len(b) > 2:
            three = (b[:-2] << np.uint32(16) | b[1:-1] << np.uint32(8) | b[2:]) * np.uint32(2654435761)
            cell = row[:-2] + 256 + (1 << 16) + (three >> np.uint32(32 - TRIGRAM_BITS))
            out[cell[row[:-2] == row[2:]]] = 1
        yield first, out.reshape(last - first, CELLS)


@dataclass(frozen=True)
class Model:
    languages: tuple[str, ...]
    cells: np.ndarray          # cells that some landmark holds
    landmarks: np.ndarray      # cells x landmarks, presence over the root of each landmark's number
    weights: np.ndarray        # (landmarks + 1) x languages, the Nystroem map folded in; last row: intercept
    least: float = 0.0         # texts that score below it are in no learned language

    def kernel(self, rows: np.ndarray) -> np.ndarray:
        sizes = np.maximum(rows.sum(1, dtype=np.int64), 1)
        shared = rows[:, self.cells].astype(np.float32) @ self.landmarks
        return shared / np.sqrt(sizes)[:, None].astype(np.float32)

    def outputs(self, rows: np.ndarray) -> np.ndarray:
        return self.kernel(rows) @ self.weights[:-1] + self.weights[-1]


def fit(texts: list[str], langs: list[str], landmarks_per_language: int = LANDMARKS) -> Model:
    """Landmarks, Nystroem map and one-versus-rest ridge regression of labelled texts (in their order).

    Every label is a language. Of more languages than ``MAX_LANDMARKS`` the first ones lend a landmark each; the
    others are told apart by the kernel values with those.
    """
    languages = tuple(sorted(set(langs)))
    column = pa.array(texts, pa.large_string())
    seen: dict[str, int] = {}
    chosen = []
    for i, lang in enumerate(langs):
        seen[lang] = seen.get(lang, 0) + 1
        if seen[lang] <= landmarks_per_language and len(chosen) < max(MAX_LANDMARKS, landmarks_per_language):
            chosen.append(i)
    marks = np.concatenate([m for _, m in presence(column.take(pa.array(chosen)))])
    cells = np.flatnonzero(marks.any(0))
    scaled = marks[:, cells].astype(np.float32) / np.sqrt(np.maximum(marks.sum(1, dtype=np.int64), 1))[:, None]
    model = Model(languages, cells, np.ascontiguousarray(scaled.T.astype(np.float32)),
                  np.zeros((len(chosen) + 1, len(languages)), np.float32))
    own = (scaled @ scaled.T).astype(np.float64)
    values, vectors = np.linalg.eigh(own)
    good = values > 1e-6 * values.max()
    root = vectors[:, good] / np.sqrt(values[good])
    x = np.concatenate([model.kernel(m) for _, m in presence(column)]).astype(np.float64) @ root
    y = np.array([[float(lang == k) for k in languages] for lang in langs]) * 2 - 1
    # every language weighs the same, however many samples it has
    weight = np.array([1 / seen[k] for k in langs])
    weight *= len(langs) / weight.sum()
    mean, y_mean = np.average(x, 0, weight), np.average(y, 0, weight)
    xc = (x - mean) * np.sqrt(weight)[:, None]
    w = np.linalg.solve(xc.T @ xc + RIDGE * len(x) * np.eye(x.shape[1]) / x.shape[1],
                        xc.T @ ((y - y_mean) * np.sqrt(weight)[:, None]))
    folded = np.vstack([root @ w, (y_mean - mean @ w)[None, :]])
    return Model(languages, cells, model.landmarks, folded.astype(np.float32))


def learn(docs: DataFrame, lang: str = "lang", text: str = "text", with_least: bool = True) -> Model | None:
    """The model of the labelled documents that are not held out; None without any.

    The model is fitted to the bounded sample, the score that ``keep_languages`` accepts comes from all those documents
    (a pass of its own, left out without ``with_least``).
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(text).alias("text"),
                       F.col(lang).cast("string").alias("lang"))
    rows = rows.where(F.col("lang").isNotNull() & ~held_out(F.col("doc_id"), FOLDS, FOLD)
                      & F.col("text").rlike(r"\p{L}"))
    sample = fetch_sample(rows, least_hashed(rows, "lang", SAMPLE_DOCS), ["doc_id", "lang"], SAMPLE_BYTES)
    if not sample:
        return None
    texts, langs = [r["text"] for r in sample], [r["lang"] for r in sample]
    model = fit(texts, langs, max(1, min(LANDMARKS, MAX_LANDMARKS // len(set(langs)))))
    return replace(model, least=least_score(rows, model)) if with_least else model


def least_score(rows: DataFrame, model: Model) -> float:
    """Half the score that ``CLEAN`` of all ``rows`` (text, lang) told right reach, rounded down to a step.

    Tasks count scores by step, so the driver gets at most ``SCORE_STEPS`` + 1 rows; repeated rows count as often.
    """
    small_batches(rows.sparkSession)
    shared = rows.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        for batch in slices(batches):
            found, score = predict(m, batch.column(0), np.ones(batch.num_rows, bool))
            right = score[found == np.array(batch.column(1).to_pylist(), object)]
            step, n = np.unique((right * SCORE_STEPS).astype(np.int64), return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(step), pa.array(n.astype(np.int64))], ["step", "n"])

    counted = rows.select("text", "lang").mapInArrow(task(run), "step long, n long").groupBy("step").agg(
        F.sum("n").alias("n")).orderBy("step").collect()
    below = np.cumsum([r["n"] for r in counted])
    if not len(below):
        return 0.0
    at = int(np.searchsorted(below, (1 - CLEAN) * (below[-1] - 1), side="right"))
    return counted[at]["step"] / SCORE_STEPS / 2


def predict(model: Model | None, texts: pa.Array, letters: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(language, score) of each text; ``letters``: whether it has one."""
    lang, score = np.full(len(texts), UND, object), np.zeros(len(texts))
    if model is not None:
        for first, rows in presence(texts):
            out = SHARPNESS * model.outputs(rows).astype(np.float64)
            p = np.exp(out - out.max(1, keepdims=True))
            best = out.argmax(1)
            at = slice(first, first + len(rows))
            lang[at] = np.array(model.languages, object)[best]
            score[at] = p[np.arange(len(rows)), best] / p.sum(1)
        lang[~letters], score[~letters] = UND, 0.0
    return lang, score


def predict_languages(docs: DataFrame, model: Model | None) -> DataFrame:
    """Per document: whether it is held out, its language and score."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        for batch in slices(batches):
            letters = np.asarray(batch.column(2).fill_null(False))
            lang, score = predict(m, batch.column(1), letters)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(lang, pa.string()), pa.array(score)],
                                             ["doc_id", "lang_pred", "score"])

    rows = doc_columns(docs).withColumn("letters", F.col("text").rlike(r"\p{L}"))
    out = rows.mapInArrow(task(run), "doc_id long, lang_pred string, score double")
    return out.select("doc_id", held_out(F.col("doc_id"), FOLDS, FOLD).alias("held_out"), "lang_pred", "score")


def keep_languages(docs: DataFrame, model: Model | None, min_score: float | None = None) -> DataFrame:
    """The rows of ``docs`` whose text has a language (not ``und``) with at least ``min_score`` (the model's least one).

    Without a model, which can judge no text, the rows whose text has a letter. Columns are kept; a null ``lang`` is
    filled with the prediction.
    """
    least = min_score if min_score is not None else model.least if model is not None else 0.0
    small_batches(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)
    names = docs.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        for batch in slices(batches):
            text = batch.column("text")
            letters = np.array([t is not None and any(map(str.isalpha, t)) for t in text.to_pylist()], bool)
            lang, score = predict(m, text, letters)
            keep = pa.array(letters if m is None else (lang != UND) & (score >= least))
            if "lang" in names:
                filled = pc.coalesce(batch.column("lang"), pa.array(lang, batch.schema.field("lang").type))
                batch = batch.set_column(names.index("lang"), batch.schema.field("lang"), filled)
            yield batch.filter(keep)

    return docs.mapInArrow(task(run), docs.schema)
