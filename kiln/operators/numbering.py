"""Dense numbers of rows in one order, without a single-task sort.

Rows are range-partitioned by the order, so equal leading values (a hot key) spread over partitions as long as the
whole order tells rows apart. Each partition numbers its own rows; the counts of the partitions before it (one
small row per partition) are added. The numbered rows are written before counting, so ranges drawn from samples are
the same for positions and totals, and a lost executor repeats single partitions only.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: ``monotonically_increasing_id`` holds the partition above this many bits and the row's place in it below
PLACE_BITS = 33


def number_rows(df: DataFrame, ranges: Sequence[str | Column], stage: Callable[[DataFrame, str], DataFrame],
                name: str = "n", ties: Sequence[str | Column] = (), first: int = 0,
                parts: int | None = None) -> DataFrame:
    """``df`` with ``name``: the row's number from ``first`` on in the order of ``ranges`` and then ``ties``.

    ``ranges`` deal the rows (short values: samples of them reach the driver); ``ties`` order rows that agree in
    them. Rows equal in both are numbered in any order. Nulls follow the given sort orders (ascending: first).
    """
    spark = df.sparkSession
    parts = parts or int(spark.conf.get("spark.sql.shuffle.partitions"))
    ordered = df.repartitionByRange(parts, *ranges).sortWithinPartitions(*ranges, *ties)
    placed = stage(ordered.withColumn("__place", F.monotonically_increasing_id()), "placed")
    part = F.shiftright("__place", PLACE_BITS).cast("int")
    counts = placed.groupBy(part.alias("__part")).agg(F.count(F.lit(1)).alias("__n"))
    before = Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)   # one row per partition
    offsets = counts.select("__part", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__before"))
    place = F.col("__place").bitwiseAND(F.lit((1 << PLACE_BITS) - 1))
    return (placed.withColumn("__part", part).join(F.broadcast(offsets), "__part")
            .withColumn(name, F.col("__before") + place + F.lit(first)).drop("__place", "__part", "__before"))
