"""Mergeable distinct counts: a stored sketch per key and day that re-aggregates to any coarser key.

HyperLogLog sketches (Spark's own functions) of 2**LG_SIZE registers: adding sketches up gives the sketch of all their
values, so a month or a year is counted from its days without reading the records again, and a new day only adds its
own sketch. The relative standard error of an estimate is below ``1.04 / sqrt(2**LG_SIZE)``; small counts are exact.
An opt-in beside the exact counts of the marts, never in their place.
"""

from __future__ import annotations

from math import sqrt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

LG_SIZE = 12
STANDARD_ERROR = 1.04 / sqrt(1 << LG_SIZE)


def sketches(df: DataFrame, keys: list[str], value: str, name: str = "sketch", lg_size: int = LG_SIZE) -> DataFrame:
    """One sketch of the distinct values per key (built map-side: a hot key ships one sketch per task). NULL values do
    not count; a key without any value has the sketch of nothing."""
    return df.groupBy(*keys).agg(F.hll_sketch_agg(F.col(value).cast("string"), F.lit(lg_size)).alias(name))


def merged(stored: DataFrame, keys: list[str], name: str = "sketch") -> DataFrame:
    """Stored sketches added up to coarser keys."""
    return stored.groupBy(*keys).agg(F.hll_union_agg(name).alias(name))


def estimate(name: str = "sketch"):
    return F.hll_sketch_estimate(name)
