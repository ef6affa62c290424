"""Operator 7: token ids as flat binary files with 64-bit document offsets.

Layout of one shard ``NNNNNN``: ``NNNNNN.ids`` holds the ids of its documents
one after another as little-endian unsigned integers (16 bit where the
vocabulary fits, else 32 bit); ``NNNNNN.idx`` holds, as little-endian 64-bit
integers, the documents' ids (``doc_id``) and then their end offsets in ids.
Shards are ranges of ``doc_id``; a shard's base in the whole sequence is the
prefix sum of the id counts of the shards before it (``manifest``).

Spark range-partitions and sorts the documents; each task encodes and writes
one shard under a name of its own attempt and renames it, so a lost executor
or a second attempt leaves whole shards only. Reading maps the files into
memory, one task per shard. The folder must be a path that all executors can
open as files (a shared mount).

Distinct units are encoded once per task, while they stay in its bounded cache (``pretokens.Units``); a unit of
ASCII and Latin-1 letters, which the normalizer only lower-cases, goes straight to the tokenizer's model as the
characters that its byte-level step gives.

Defined cases: null text is empty and holds the end id only; strings of special tokens in a text become their ids,
as in the library's plain call; a very long text is a slice of its own; repeated doc_ids
stand next to each other, ordered by text; null ones come first; an empty table writes no shard and
reads as an empty result; other columns are ignored.
"""

from __future__ import annotations

import os
import string
import uuid
import zlib
from collections.abc import Iterator
from urllib.parse import urlparse

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import Workspace, doc_columns, slices, strings, task
from .pretokens import Cache, Units

END_ID = 2
#: stands for a null doc_id in a file
NO_ID = np.iinfo(np.int64).min
#: text bytes encoded at once
TOKEN_SLICE = 4 << 20
#: letters of Latin-1 beyond ASCII; alone they compose to nothing else, and each has one letter as its lower case
LATIN_1 = "".join(c for c in map(chr, range(0xC0, 0x100)) if c.isalpha())
LETTERS = string.ascii_lowercase + LATIN_1


def _byte_characters() -> str:
    """The character that stands for each byte in a byte-level vocabulary: itself if printable, else 256 and on."""
    plain = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    moved = (chr(256 + i) for i in range(256))
    return "".join(chr(b) if b in plain else next(moved) for b in range(256))


BYTE_CHARACTERS = _byte_characters()


class IdBytes(dict):
    """Id -> its bytes in a file, made when first asked for."""

    def __init__(self, dtype: np.dtype):
        super().__init__()
        self.dtype = dtype

    def __missing__(self, token: int) -> bytes:
        self[token] = raw = np.array(token, self.dtype).tobytes()
        return raw


class WordTokenizer:
    """Ids of texts by a ``tokenizers`` file, as its plain ``encode`` call without added special tokens gives them.

    A text that holds the string of a special token goes whole through that call, which gives the token's id; all
    others are encoded unit by unit.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        self.load_plain, self.plain = (lambda: Tokenizer.from_file(path)), None    # loaded by the first text that needs it
        self.tokenizer = Tokenizer.from_file(path)
        # a token that the library looks for in normalised text may stand there in other case
        self.special = [(t.content, t.normalized) for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.tokenizer.encode_special_tokens = True        # a unit may look like one once it is lower-cased
        self.dtype = np.dtype("<u2" if self.tokenizer.get_vocab_size() <= 1 << 16 else "<u4")
        self.cache = Cache(self._units)
        self.model = self.tokenizer.model
        self.code = IdBytes(self.dtype)

    def _units(self, units: list[str]) -> list[bytes]:
        out, tokenize, code = [], self.model.tokenize, self.code
        for u in units:
            word = u.strip(" ")
            if word.isascii() and word.isalpha():
                tokens = tokenize(word)
            elif not word.strip(LETTERS) and word:
                tokens = tokenize(word.lower().encode().decode("latin-1").translate(BYTE_CHARACTERS))
            else:
                ids = self.tokenizer.encode(u, add_special_tokens=False).ids
                out.append(b"".join([code[i] for i in ids]))
                continue
            out.append(b"".join([code[t.id] for t in tokens]))
        return out

    def encode(self, texts: pa.Array) -> pa.Array:
        """The ids of each text as the file's unsigned integers."""
        marked = np.zeros(len(texts), bool)
        for content, normalized in self.special:
            marked |= np.asarray(pc.match_substring(texts, content, ignore_case=normalized))
        rest = pc.if_else(pa.array(marked), pa.scalar("", texts.type), texts) if marked.any() else texts
        units = Units(rest, lower=True)
        coded = units.join(pa.array(self.cache.look_up(units.distinct), pa.binary()), b"")
        if not marked.any():
            return coded
        self.plain = self.plain or self.load_plain()
        out = coded.to_pylist()
        for i in np.flatnonzero(marked):
            out[i] = np.array(self.plain.encode(texts[i].as_py(), add_special_tokens=False).ids, self.dtype).tobytes()
        return pa.array(out, pa.binary())


def local_path(folder: str) -> str:
    """The folder as a path that executors open as files."""
    url = urlparse(folder)
    if url.scheme not in ("", "file"):
        raise ValueError(f"token files need a folder mounted on all executors, not {folder}")
    return url.path


def write_token_files(docs: DataFrame, path: str, folder: str, end_id: int = END_ID) -> DataFrame:
    """Write the shards; the manifest: shard, file, n_docs, n_ids (one row per shard, as a lazy DataFrame)."""
    target = local_path(folder)

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext
        shard = TaskContext.get().partitionId()
        coder = WordTokenizer(path)
        name, own = f"{target}/{shard:06d}", uuid.uuid4().hex
        doc_ids, counts, ids_file = [], [], None
        end = np.array([end_id], coder.dtype).tobytes()
        for batch in slices(batches, limit=TOKEN_SLICE):
            if ids_file is None:
                os.makedirs(target, exist_ok=True)
                ids_file = open(f"{name}.ids.{own}", "wb")
            coded = coder.encode(strings(batch.column(1)))
            doc_ids.append(np.asarray(batch.column(0).fill_null(NO_ID), np.int64))
            counts.append(np.asarray(pc.binary_length(coded), np.int64) // coder.dtype.itemsize + 1)
            for x in coded:
                ids_file.write(x.as_buffer())
                ids_file.write(end)
        if ids_file is None:
            return
        ids_file.close()
        ends = np.cumsum(np.concatenate(counts))
        with open(f"{name}.idx.{own}", "wb") as f:
            f.write(np.concatenate(doc_ids).astype("<i8").tobytes())
            f.write(ends.astype("<i8").tobytes())
        for kind in ("ids", "idx"):
            os.replace(f"{name}.{kind}.{own}", f"{name}.{kind}")
        yield pa.RecordBatch.from_pydict({"shard": [shard], "file": [name], "n_docs": [len(ends)],
                                          "n_ids": [int(ends[-1])], "width": [coder.dtype.itemsize]})

    spark = docs.sparkSession
    shards = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ordered = doc_columns(docs).repartitionByRange(shards, F.col("doc_id").asc_nulls_first())
    return ordered.sortWithinPartitions(F.col("doc_id").asc_nulls_first(), "text").mapInArrow(
        task(write), "shard long, file string, n_docs long, n_ids long, width long")


def with_bases(manifest: DataFrame) -> DataFrame:
    """The manifest with each shard's first position in the whole sequence (one row per shard: a small window)."""
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    return manifest.withColumn("base", F.coalesce(F.sum("n_ids").over(before), F.lit(0)))


READ_SCHEMA = "doc_id long, start long, n_tokens long, ids_crc32 long"


def read_token_files(manifest: DataFrame) -> DataFrame:
    """Per document, from the mapped files: its start in the whole sequence, its id count and their checksum."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                ids = np.memmap(f"{row['file']}.ids", f"<u{row['width']}", "r")
                index = np.memmap(f"{row['file']}.idx", "<i8", "r")
                doc_ids, ends = index[:row["n_docs"]], np.asarray(index[row["n_docs"]:])
                if len(ends) != row["n_docs"] or len(ids) != row["n_ids"] or int(ends[-1]) != row["n_ids"]:
                    raise ValueError(f"{row['file']}: files do not match the manifest")
                starts = np.concatenate([[0], ends[:-1]])
                for a in range(0, len(ends), 10_000):
                    z = min(a + 10_000, len(ends))
                    sums = [zlib.crc32(ids[s:e].astype("<u4").tobytes()) for s, e in zip(starts[a:z], ends[a:z])]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.asarray(doc_ids[a:z]), mask=np.asarray(doc_ids[a:z]) == NO_ID), pa.array(starts[a:z] + row["base"]),
                         pa.array(ends[a:z] - starts[a:z]), pa.array(sums, pa.int64())],
                        ["doc_id", "start", "n_tokens", "ids_crc32"])

    return manifest.mapInArrow(task(read), READ_SCHEMA)


def token_binary(spark: SparkSession, docs: DataFrame, path: str, folder: str | None = None) -> DataFrame:
    """Write ``docs`` as token files (under the shared folder by default) and read them back, one row per document."""
    work = Workspace(spark, "tokens")
    manifest = work.stage(write_token_files(docs, path, folder or f"{work.base}/shards"), "manifest")
    shards = with_bases(manifest)
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return read_token_files(shards.repartitionById(parts, F.pmod("shard", F.lit(parts)).cast("int")))
