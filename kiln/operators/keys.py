"""Foreign-key membership flags and orphan detection.

A dimension that is too large to broadcast would move and sort the whole rows of a fact for one flag. ``by_absence``
looks at the keys alone first: keys of the fact that the dimension lacks are measured, and where they are few they stand
for the dimension as a broadcast set. Where they are too many as well, the dimension is joined as it is.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .dedup import By, keep_best, keep_best_apart
from .sizing import JoinSide, fits_a_task, measure, unwrap


@dataclass(frozen=True)
class AbsentKeys:
    """All keys of a fact (text, in column ``key``) that a dimension lacks, within the broadcast bounds."""

    df: DataFrame


def beyond_bounds(sides: dict[str, tuple[object, str]]) -> dict[str, tuple[JoinSide, str]]:
    """The measured dimensions whose key alone is too large to broadcast: column -> (dimension, its key)."""
    return {fk: (side, key) for fk, (side, key) in sides.items()
            if isinstance(side, JoinSide) and side.book is not None and side.book.stage is not None
            and not side.pick([key]).broadcast}


def present_keys(side: JoinSide, key: str) -> DataFrame:
    """The keys of a measured dimension for an anti-join: hashed, neither sorted nor made distinct, where a task can hold
    its part of them."""
    keys = side.df.select(F.col(key).alias("key")).where("key is not null")
    if fits_a_task(keys.sparkSession, side.book.size(side.name, [key])[1]):
        return keys.hint("shuffle_hash")
    return keys.distinct().hint("merge")


def best_by_absence(df: DataFrame, keys: list[str], order: list[By], sides: dict[str, tuple[object, str]],
                    tables: dict[str, tuple[DataFrame, str]] | None = None,
                    drop: tuple[str, ...] = ()) -> tuple[DataFrame, dict[str, object]]:
    """``by_absence`` of the best rows of ``df`` (``keep_best``) without the columns ``drop``.

    With a dimension beyond the bounds, rows are written once before they compete, and rows whose key is unique are not
    moved.
    """
    large = beyond_bounds(sides)
    if not large:
        return by_absence(keep_best(df, keys, order).drop(*drop), sides, tables)
    best, rows = keep_best_apart(df, keys, order, next(iter(large.values()))[0].book)
    return by_absence(best.drop(*drop), sides, tables, rows)


def by_absence(df: DataFrame, sides: dict[str, tuple[object, str]],
               tables: dict[str, tuple[DataFrame, str]] | None = None,
               written: DataFrame | None = None) -> tuple[DataFrame, dict[str, object]]:
    """``df`` and what ``with_known_flag`` should join for each foreign key (text): column -> (dimension, its key).

    Measured sides beyond the broadcast bounds are replaced by their ``AbsentKeys`` if these are within them. For that
    the rows are written once, and the distinct keys are read from the files; ``tables`` (other facts) are checked along
    with them. Without such a side all is returned as it is. ``written``: files that hold every key of ``df`` already.
    """
    known = {fk: side for fk, (side, _) in [*sides.items(), *(tables or {}).items()]}
    found = beyond_bounds(sides)
    if not found:
        return df, known
    book = next(iter(found.values()))[0].book
    if written is None:
        df = written = book.stage(df, "fact-rows")
    rows = written
    keys = {fk: present_keys(side, key) for fk, (side, key) in found.items()}
    keys.update({fk: dim.select(F.col(key).alias("key")).distinct().hint("merge") for fk, (dim, key) in (tables or {}).items()})
    for fk, present in keys.items():
        used = rows.select(F.col(fk).alias("key")).where("key is not null").distinct()
        absent = book.stage(used.join(present, "key", "left_anti"), f"absent-{fk}")
        if book.fits(*measure(absent)):
            known[fk] = AbsentKeys(absent)
    return df, known


def with_known_flag(df: DataFrame, fk: str, dim, dim_key: str, flag: str,
                    carry: list[str] | None = None, distinct: bool = False) -> DataFrame:
    """Add ``flag`` = 1 if ``df.fk`` exists in ``dim.dim_key`` else 0; optionally carry dim columns.

    ``dim_key`` must be unique in ``dim`` (dimensions are deduplicated); pass
    ``distinct=True`` for a fact-to-fact membership check, which turns the
    right side into a distinct key set first (aggregated map-side). For ``AbsentKeys``
    the flag is 0 where the key is one of them or NULL.
    """
    probe = f"__probe_{flag}"
    if isinstance(dim, AbsentKeys):
        right = F.broadcast(dim.df.select(F.col("key").alias(f"__key_{flag}"), F.lit(1).alias(probe)))
        out = df.join(right, df[fk] == right[f"__key_{flag}"], "left")
        out = out.withColumn(flag, F.when(F.col(probe).isNotNull() | F.col(fk).isNull(), F.lit(0)).otherwise(F.lit(1)))
        return out.drop(probe, f"__key_{flag}")
    if isinstance(dim, JoinSide):
        dim = dim.pick(list(dict.fromkeys([dim_key, *(carry or [])])))
    dim, finish = unwrap(dim)  # a size-checked JoinSide carries its broadcast / merge decision
    right = dim.select(F.col(dim_key).alias(f"__key_{flag}"), *(carry or []))
    if distinct:
        right = right.distinct()
    right = finish(right.withColumn(probe, F.lit(1)))
    out = df.join(right, df[fk] == right[f"__key_{flag}"], "left")
    out = out.withColumn(flag, F.when(F.col(probe).isNotNull(), F.lit(1)).otherwise(F.lit(0)))
    return out.drop(probe, f"__key_{flag}")


def orphans(df: DataFrame, fk: str, dim, dim_key: str, keep_null_keys: bool) -> DataFrame:
    """Rows of ``df`` whose key is absent from ``dim`` (anti join).

    ``keep_null_keys`` = True reports NULL keys as orphans (a NULL never matches);
    False drops them first.
    """
    left = df if keep_null_keys else df.where(F.col(fk).isNotNull())
    dim, finish = unwrap(dim.pick([dim_key]) if isinstance(dim, JoinSide) else dim)
    right = finish(dim.select(F.col(dim_key).alias("__dim_key")))
    return left.join(right, left[fk] == right["__dim_key"], "left_anti")
