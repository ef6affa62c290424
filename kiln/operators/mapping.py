"""Taxonomy standardisation (mapping table lookups).

A raw value is matched to the active mapping of one type on
``lower(trim(value))``; the standard value wins, otherwise a fallback of the
raw text is kept. The join side is one slice of the taxonomy. Slices differ
wildly in size (a handful of regions vs. one row per product spelling), so a
``Taxonomy`` measures every slice once (one grouped count) and broadcasts only
the slices within the row and byte bounds; larger slices go through a shuffle join, hashed where a task's part of
the slice is small, so that whole rows need not be sorted by their text for it.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import c, nb
from .sizing import DEFAULT_MAX_BROADCAST_BYTES, JoinSide, fits_a_task, row_bytes, unwrap

FALLBACKS = ("trim", "blank_null", "upper")


@dataclass(frozen=True)
class MappingRule:
    """Standardise ``source`` through mapping type ``mapping_type`` into ``output``."""

    source: str
    mapping_type: str
    output: str
    fallback: str = "trim"  # trim | blank_null | upper

    def __post_init__(self):
        if self.fallback not in FALLBACKS:
            raise ValueError(f"unknown fallback {self.fallback!r}")


class Taxonomy:
    """A standardised mapping table plus the measured size of each active slice."""

    def __init__(self, df: DataFrame, max_broadcast_rows: int, max_broadcast_bytes: int = DEFAULT_MAX_BROADCAST_BYTES,
                 slice_rows: dict[str, int] | None = None, on_duplicate: str = "fan_out"):
        if on_duplicate not in ("fan_out", "raise"):
            raise ValueError(f"unknown choice for duplicate mappings {on_duplicate!r}")
        self.df = df
        self.max_broadcast_rows, self.max_broadcast_bytes = max_broadcast_rows, max_broadcast_bytes
        self.on_duplicate = on_duplicate
        self._sizes = None if slice_rows is None else {k: (n, 0) for k, n in slice_rows.items()}

    def slice_sizes(self) -> dict[str, tuple[int, int]]:
        """(rows, bytes) of every active slice."""
        if self._sizes is None:
            if self.on_duplicate == "raise":
                twice = duplicate_mappings(self.df).orderBy("mapping_type", "match_key").limit(10).collect()
                if twice:
                    raise ValueError("several active mappings of one key: " + ", ".join(
                        f"{r['mapping_type']} {r['match_key']!r}" for r in twice))
            active = self.df.where(F.col("is_active") == 1).select("mapping_type", "raw_value", "standard_value")
            counted = (active.groupBy("mapping_type")
                       .agg(F.count(F.lit(1)).alias("n"), F.sum(row_bytes(active)).alias("size"))
                       .collect())  # one row per mapping type
            self._sizes = {r["mapping_type"]: (r["n"], r["size"]) for r in counted}
        return self._sizes

    def slice(self, mapping_type: str) -> JoinSide:
        rows, size = self.slice_sizes().get(mapping_type, (0, 0))
        # a row of many repeats of one key meets them all either way: the side needs no sorting to bound that
        return JoinSide(_slice(self.df, mapping_type),
                        rows <= self.max_broadcast_rows and size <= self.max_broadcast_bytes,
                        hashed=fits_a_task(self.df.sparkSession, size))


def _slice(taxonomy: DataFrame, mapping_type: str) -> DataFrame:
    return (taxonomy
            .where((F.col("mapping_type") == mapping_type) & (F.col("is_active") == 1))
            .select(F.lower(F.trim("raw_value")).alias("match_key"),
                    F.col("standard_value")))


def mapping_slice(taxonomy, mapping_type: str):
    """Active rows of one mapping type as (match_key, standard_value) (a ``JoinSide`` for a ``Taxonomy``)."""
    if isinstance(taxonomy, Taxonomy):
        return taxonomy.slice(mapping_type)
    return _slice(taxonomy, mapping_type)


def lookup(df: DataFrame, taxonomy, source: str, mapping_type: str,
           output: str) -> DataFrame:
    """Left-join the mapping slice; adds ``output`` = standard value or NULL.

    Duplicate active mappings for one key would multiply rows (the source
    model allows it); ``duplicate_mappings`` reports such keys.
    """
    key = f"__mk_{output}"
    sl, finish = unwrap(mapping_slice(taxonomy, mapping_type))
    sl = finish(sl.select(F.col("match_key").alias(key), F.col("standard_value").alias(output)))
    return (df.withColumn(key, F.lower(F.trim(c(source))))
            .join(sl, on=key, how="left")
            .drop(key))


def fallback_value(rule: MappingRule) -> Column:
    raw = c(rule.source)
    if rule.fallback == "trim":
        return F.trim(raw)
    if rule.fallback == "blank_null":
        return nb(raw)
    return F.upper(F.trim(raw))


def standardize(df: DataFrame, taxonomy, rules: list[MappingRule]) -> DataFrame:
    """Apply several mapping rules; each adds ``rule.output`` (standard or fallback)."""
    out = df
    for r in rules:
        std = f"__std_{r.output}"
        out = lookup(out, taxonomy, r.source, r.mapping_type, std)
        out = out.withColumn(r.output, F.coalesce(F.col(std), fallback_value(r))).drop(std)
    return out


def duplicate_mappings(taxonomy: DataFrame) -> DataFrame:
    """Active (mapping_type, key) pairs with more than one mapping row (would fan out joins)."""
    return (taxonomy.where(F.col("is_active") == 1)
            .groupBy("mapping_type", F.lower(F.trim("raw_value")).alias("match_key"))
            .agg(F.count(F.lit(1)).alias("n_mappings"))
            .where(F.col("n_mappings") > 1))
