"""Shared pieces of the training-data operators: tables, staging, Arrow batches.

Staging writes a table under the cluster's shared ``spark.checkpoint.dir`` and
re-reads it, which cuts lineage: a lost executor recomputes one step, not the
whole operator.
"""

from __future__ import annotations

import ctypes
import gc
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from ..plans.dag import shared_folder

#: rows and bytes of an Arrow batch: the JVM and a worker each hold a few batches besides their own data
BATCH_ROWS, BATCH_BYTES = 1_500, 8 << 20
#: text bytes and rows handled at once inside a task (a single longer document is a slice of its own)
SLICE_BYTES, SLICE_ROWS = 2 << 20, 20_000


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


class Workspace:
    """One run's folder of staged tables in the shared checkpoint folder."""

    def __init__(self, spark: SparkSession, name: str):
        self.spark = spark
        self.base = f"{shared_folder(spark)}/kiln-llm-{name}-{uuid.uuid4().hex[:12]}"
        self._n = 0
        # staged steps never reuse an earlier step's shuffle files, so let Spark drop them as each write ends
        spark.conf.set("spark.sql.classic.shuffleDependency.fileCleanup.enabled", "true")

    def stage(self, df: DataFrame, name: str) -> DataFrame:
        self._n += 1
        path = f"{self.base}/{self._n:02d}-{name}"
        df.write.mode("overwrite").parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)


def strings(column: pa.Array | pa.ChunkedArray) -> pa.Array:
    """A text (or bytes) column as one plain array; nulls become empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    large = pa.large_binary() if pa.types.is_binary(column.type) or pa.types.is_large_binary(column.type) \
        else pa.large_string()
    column = column.cast(large)
    return column.fill_null("") if column.null_count else column


def text_bytes(column) -> tuple[np.ndarray, np.ndarray]:
    """(bytes of all texts joined, int64 offsets): zero-copy views of an Arrow text column."""
    arr = strings(column)
    offsets = np.frombuffer(arr.buffers()[1], np.int64)[arr.offset:arr.offset + len(arr) + 1]
    data = arr.buffers()[2]
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[offsets[0]:offsets[-1]] if len(arr) else raw[:0], offsets - offsets[0]


def slices(batches: Iterator[pa.RecordBatch], text: str = "text",
           limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut Arrow batches into runs of rows holding at most ``limit`` text bytes and SLICE_ROWS rows (at least one)."""
    for batch in batches:
        if not batch.num_rows:
            continue
        _, offsets = text_bytes(batch.column(batch.schema.get_field_index(text)))
        start = 0
        while start < batch.num_rows:
            end = int(np.searchsorted(offsets, offsets[start] + limit, side="right")) - 1
            end = max(start + 1, min(end, start + SLICE_ROWS, batch.num_rows))
            yield batch.slice(start, end - start)
            start = end


def small_batches(spark: SparkSession) -> None:
    """Bound the Arrow batches between the JVM and its workers (smaller settings are left alone)."""
    for key, most in (("spark.sql.execution.arrow.maxRecordsPerBatch", BATCH_ROWS),
                      ("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES)):
        now = str(spark.conf.get(key, None)).rstrip("b")       # None where it is not set
        if not now.isdigit() or not 0 < int(now) <= most:
            spark.conf.set(key, str(most))


def _give_back() -> None:
    """Return freed memory to the system, so that an idle worker holds little."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL("libc.so.6").malloc_trim(0)
    except (OSError, AttributeError):      # another C library
        pass


def task(run):
    """``run`` as a task that gives its memory back when it ends."""
    def whole(batches):
        try:
            yield from run(batches)
        finally:
            _give_back()
    return whole


def doc_columns(docs: DataFrame) -> DataFrame:
    """The two columns the text operators read (extra columns never reach a task)."""
    small_batches(docs.sparkSession)
    return docs.select(docs["doc_id"].cast("long").alias("doc_id"), docs["text"].cast("string").alias("text"))
