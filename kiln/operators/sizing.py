"""Broadcast only behind a size check.

A join side is broadcast only when its row count is known and at most
``max_rows`` and its values take at most ``max_bytes``; a larger side carries an explicit sort-merge (``merge``) hint,
so neither the static planner (whose estimate is the compressed file size)
nor AQE ships it to every executor; AQE skew splitting still applies. Both
come from one small job on the side itself (a scan of a dimension).
"""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import reduce
from typing import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

DEFAULT_MAX_BROADCAST_ROWS, DEFAULT_MAX_BROADCAST_BYTES = 2_000_000, 256 << 20
CONF_KEY, BYTES_CONF_KEY = "spark.kiln.broadcast.maxRows", "spark.kiln.broadcast.maxBytes"
#: what a row costs in a hash table besides its text
ROW_BYTES = 48
#: input rows that one shuffle partition should take; a task sorts its whole partition in memory
PARTITION_ROWS = 500_000
#: bytes of a side that a task may hold as a hash table
PARTITION_BYTES = 16 << 20


def max_broadcast_rows(spark: SparkSession) -> int:
    return int(spark.conf.get(CONF_KEY, str(DEFAULT_MAX_BROADCAST_ROWS)))


def max_broadcast_bytes(spark: SparkSession) -> int:
    return int(spark.conf.get(BYTES_CONF_KEY, str(DEFAULT_MAX_BROADCAST_BYTES)))


def row_bytes(df: DataFrame) -> Column:
    """About what a row of ``df`` takes: its text, 8 bytes for other values, and the row itself."""
    text = [F.coalesce(F.octet_length(n), F.lit(0)) for n, t in df.dtypes if t == "string"]
    return reduce(lambda x, y: x + y, text, F.lit(ROW_BYTES + 8 * (len(df.columns) - len(text))).cast("bigint"))


def measure(df: DataFrame) -> tuple[int, int]:
    """(rows, bytes) of a side."""
    n, size = df.agg(F.count(F.lit(1)), F.coalesce(F.sum(row_bytes(df)), F.lit(0))).first()
    return n, size


def measure_columns(df: DataFrame) -> tuple[int, dict[str, int]]:
    """(rows, bytes of each column's values) of a side."""
    size = {n: F.sum(F.octet_length(n)) if t == "string" else F.count(F.lit(1)) * 8 for n, t in df.dtypes}
    rows, *sizes = df.agg(F.count(F.lit(1)), *[F.coalesce(x, F.lit(0)) for x in size.values()]).first()
    return rows, dict(zip(size, sizes))


def enough_partitions(spark: SparkSession, rows: int) -> None:
    """Raise the session's shuffle partitions (never lower them) so that what a task sorts does not grow with ``rows``.

    The runtime still coalesces small partitions and splits skewed ones.
    """
    key, needed = "spark.sql.shuffle.partitions", -(-rows // PARTITION_ROWS)
    if int(spark.conf.get(key)) < needed:
        spark.conf.set(key, str(needed))


def fits_a_task(spark: SparkSession, size: int) -> bool:
    """Whether a shuffle partition of a side of ``size`` bytes, if keys spread evenly, is small enough to be hashed."""
    return size <= PARTITION_BYTES * int(spark.conf.get("spark.sql.shuffle.partitions"))


@dataclass(frozen=True)
class JoinSide:
    """A lookup side plus the measured decision; the hint goes on the exact frame that is joined.

    (A hint placed before further projections would not reach the join.) ``book`` and ``name`` say where the side was
    measured, so that ``pick`` can judge some of its columns alone. ``hashed``: a task can hold its part of the side in
    memory, so that the rows that are joined with it need not be sorted.
    """

    df: DataFrame
    broadcast: bool
    book: SizeBook | None = None
    name: str | None = None
    hashed: bool = False

    def pick(self, columns: list[str]) -> JoinSide:
        """The side with the columns that a join reads: what is not shipped does not count."""
        narrow = self.df.select(*columns)
        return JoinSide(narrow, self.broadcast if self.book is None else self.book.fits(*self.book.size(self.name, columns)))

    def finish(self, right: DataFrame) -> DataFrame:
        if self.broadcast:
            return F.broadcast(right)
        return right.hint("shuffle_hash" if self.hashed else "merge")


def unwrap(side) -> tuple[DataFrame, Callable[[DataFrame], DataFrame]]:
    """(frame, finisher) for a ``JoinSide`` or a plain DataFrame (no hint: the planner decides)."""
    if isinstance(side, JoinSide):
        return side.df, side.finish
    return side, (lambda right: right)


@dataclass
class SizeBook:
    """Sizes of join sides, measured once per run; ``stage`` writes a step and reads it back, where there is a folder."""

    max_rows: int
    max_bytes: int = DEFAULT_MAX_BROADCAST_BYTES
    counts: dict = field(default_factory=dict)
    stage: Callable[[DataFrame, str], DataFrame] | None = None

    def fits(self, rows: int, size: int) -> bool:
        return rows <= self.max_rows and size <= self.max_bytes

    def size(self, name: str, columns) -> tuple[int, int]:
        """(rows, bytes) of some columns of a measured side."""
        rows, sizes = self.counts[name]
        return rows, rows * ROW_BYTES + sum(sizes[c] for c in columns)

    def side(self, name: str, df: DataFrame) -> JoinSide:
        if name not in self.counts:
            self.counts[name] = measure_columns(df)
        return JoinSide(df, self.fits(*self.size(name, df.columns)), self, name)
