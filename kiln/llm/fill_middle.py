"""Operator 12: fill-in-middle transformation with repeated-capture matching.

One ``regex`` full match of ``(unit)*`` retains every repetition of its group: ``match.ends(1)`` is the list of all
unit ends, so its length is the number of units and two of its items are the cut offsets. No loop over units.

A document's two cuts, whether it is transformed and which form it takes are the first four 32-bit groups of the
SHA-256 of ``seed:doc_id``, so a document is cut alike in every run and on every executor. Forms, with marks P, S, M:
``psm`` is P prefix S suffix M middle, ``spm`` is S suffix P prefix M middle, ``plain`` is the text itself. Narrow:
no shuffle, no collect.

Defined cases: null text is empty; an empty text, one that holds a mark, and one that units do not cover are plain
(null lengths; ``n`` counts the units matched, 0 where they do not cover it); a null doc_id is hashed as nothing
after the colon; very long texts are a slice of their own and are matched whole (some 100 bytes of memory a unit);
repeated rows give repeated rows; there are no ties; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import doc_columns, slices, strings, task

LINE = r"[^\n]*\n|[^\n]+"
MARKS = ("<P>", "<S>", "<M>")
SCHEMA = "doc_id long, n long, form string, prefix_chars long, middle_chars long, output string"


class Cutter:
    """Cuts texts into prefix, middle and suffix at unit borders."""

    def __init__(self, unit: str = LINE, marks: tuple[str, str, str] = MARKS, seed: int = 7, percent: int = 100,
                 spm_percent: int = 50):
        import regex
        self.match = regex.compile(f"({unit})*").fullmatch
        self.marks, self.seed, self.percent, self.spm_percent = marks, seed, percent, spm_percent

    def draws(self, doc_id: int | None) -> list[int]:
        key = f"{self.seed}:{'' if doc_id is None else doc_id}".encode()
        digest = hashlib.sha256(key).digest()
        return [int.from_bytes(digest[k:k + 4], "big") for k in (0, 4, 8, 12)]

    def cut(self, doc_id: int | None, text: str) -> tuple[int, str, int | None, int | None, str]:
        """(n, form, prefix_chars, middle_chars, output)"""
        found = self.match(text)
        ends = found.ends(1) if found else []
        n = len(ends)
        h1, h2, h3, h4 = self.draws(doc_id)
        if not text or not found or any(m in text for m in self.marks) or h3 % 100 >= self.percent:
            return n, "plain", None, None, text
        low, high = sorted((h1 % (n + 1), h2 % (n + 1)))
        a, z = ends[low - 1] if low else 0, ends[high - 1] if high else 0
        p, s, m = self.marks
        prefix, middle, suffix = text[:a], text[a:z], text[z:]
        if h4 % 100 < self.spm_percent:
            return n, "spm", a, z - a, f"{s}{suffix}{p}{prefix}{m}{middle}"
        return n, "psm", a, z - a, f"{p}{prefix}{s}{suffix}{m}{middle}"


def fill_in_middle(docs: DataFrame, unit: str = LINE, marks: tuple[str, str, str] = MARKS, seed: int = 7,
                   percent: int = 100, spm_percent: int = 50) -> DataFrame:
    """Per document: units, form, lengths of prefix and middle in code points, and the transformed text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cutter = Cutter(unit, marks, seed, percent, spm_percent)
        names = ["n", "form", "prefix_chars", "middle_chars", "output"]
        types = [pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string()]
        for batch in slices(batches):
            rows = [cutter.cut(i, t) for i, t in zip(batch.column(0).to_pylist(),
                                                     strings(batch.column(1)).to_pylist())]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *(pa.array(c, t) for c, t in zip(zip(*rows), types))], ["doc_id", *names])

    return doc_columns(docs).mapInArrow(task(run), SCHEMA)


def restored(output: Column, form: Column, marks: tuple[str, str, str] = MARKS) -> Column:
    """The text rebuilt from the output and its form (column expression)."""
    p, s, m = marks
    first_of = {"psm": p, "spm": s}
    body = {f: output.substr(F.lit(len(mark) + 1), F.length(output)) for f, mark in first_of.items()}
    head = lambda x, mark: F.substring_index(x, mark, 1)
    tail = lambda x, mark: F.substring_index(x, mark, -1)
    psm = F.concat(head(body["psm"], s), tail(body["psm"], m), head(tail(body["psm"], s), m))
    spm = F.concat(head(tail(body["spm"], p), m), tail(body["spm"], m), head(body["spm"], p))
    return F.when(form == "psm", psm).when(form == "spm", spm).otherwise(output)


def fill_in_middle_digests(docs: DataFrame) -> DataFrame:
    """The transformed documents as digests of the output and of the text rebuilt from it."""
    out = fill_in_middle(docs)
    return out.select("doc_id", "n", "form", "prefix_chars", "middle_chars",
                      F.sha2("output", 256).alias("output_sha256"),
                      F.sha2(restored(F.col("output"), F.col("form")), 256).alias("restored_sha256"))
