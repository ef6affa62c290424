"""Top-1 per group ("keep the best row") with a total order.

``row_number`` + ``rn = 1`` lets Catalyst plan a WindowGroupLimit on both
sides of the exchange: each map task keeps only its best row per key before
the shuffle, so even a key holding a third of the table ships one row per map
task, not all of its rows.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .sizing import SizeBook, measure

#: one of this many key hashes is counted first to judge whether repeated keys are few
HASH_PARTS = 64


@dataclass(frozen=True)
class By:
    """One ordering term: an expression, direction and null placement."""

    expr: object
    desc: bool = False
    nulls_last: bool | None = None  # None = Spark default (asc nulls first, desc nulls last)

    def column(self) -> Column:
        e = F.col(self.expr) if isinstance(self.expr, str) else self.expr
        nl = self.nulls_last if self.nulls_last is not None else self.desc
        if self.desc:
            return e.desc_nulls_last() if nl else e.desc_nulls_first()
        return e.asc_nulls_last() if nl else e.asc_nulls_first()


def total_order(df: DataFrame, keys: list[str], order: list[By]) -> list[Column]:
    """The given order plus every other column ascending, so ties resolve the same way every run."""
    used = set(keys) | {o.expr for o in order if isinstance(o.expr, str)}
    tail = [F.col(n).asc_nulls_first() for n in df.columns if n not in used]
    return [o.column() for o in order] + tail


def keep_best(df: DataFrame, keys: list[str], order: list[By], deterministic: bool = True) -> DataFrame:
    """One row per ``keys``: the first row under ``order`` (then all other columns)."""
    ordering = total_order(df, keys, order) if deterministic else [o.column() for o in order]
    w = Window.partitionBy(*keys).orderBy(*ordering)
    return (df.withColumn("__rn", F.row_number().over(w))
            .where(F.col("__rn") == 1)
            .drop("__rn"))


def _repeated(hashes: DataFrame) -> DataFrame:
    return hashes.groupBy("__hash").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("__hash")


def keep_best_apart(df: DataFrame, keys: list[str], order: list[By], book: SizeBook) -> tuple[DataFrame, DataFrame]:
    """``keep_best`` of ``df``, and all rows of ``df`` as files.

    Rows whose key hash is unique are kept where they are; the others, found through a broadcast set of hashes, compete
    as in ``keep_best`` (keys that merely share a hash do so too, each for itself). Where the repeated hashes exceed the
    broadcast bounds, all rows compete.
    """
    rows = book.stage(df, "rows")
    hashed = F.xxhash64(*keys)
    hashes = rows.select(hashed.alias("__hash"))
    if _repeated(hashes.where(F.pmod("__hash", F.lit(HASH_PARTS)) == 0)).count() * HASH_PARTS <= book.max_rows:
        repeated = book.stage(_repeated(hashes), "repeated-keys")
        if book.fits(*measure(repeated)):
            repeats = hashed == F.col("__hash")
            some = rows.join(F.broadcast(repeated), repeats, "left_semi")
            best = book.stage(keep_best(some, keys, order), "best-rows")
            return rows.join(F.broadcast(repeated), repeats, "left_anti").unionByName(best), rows
    return keep_best(rows, keys, order), rows
