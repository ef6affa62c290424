"""Snapshots as history: every version of a key with the days it held (slowly-changing rows, type 2).

A snapshot is compared with the open versions by a hash of the tracked columns. A new key opens a version on the
snapshot's day; a changed one closes its open version the day before and opens another; a key that is missing is
closed, and opens anew when it comes back. Closed versions are never read again by later snapshots: each snapshot
adds one folder of them (``closed/closed_on=day``) and writes the open versions (``open/as_of=day``).

Applying a snapshot of the last day again starts from the open versions before it and writes the same rows to the same
folders, which also repairs a run that died halfway; an earlier day is refused. A day without a complete folder of
open versions was never applied, so its closed versions are not read. Work per snapshot: one full outer join of the
open versions with the snapshot (keys of one row each, so no hot keys).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, StringType, StructField, StructType

from ..operators.dedup import keep_best
from .upsert import Folder

FROM, TO, HASH = "valid_from", "valid_to", "row_hash"


def row_hash(columns: list[str]) -> Column:
    """A hash of the columns by name; NULL differs from any text."""
    return F.sha2(F.to_json(F.struct(*columns), {"ignoreNullFields": "false"}), 256)


class HistoryTable:
    """Versions of rows of ``schema`` under ``path``; every column that is no key is tracked."""

    def __init__(self, spark: SparkSession, path: str, schema: StructType, keys: list[str]):
        self.spark, self.path, self.keys = spark, path.rstrip("/"), keys
        self.columns = schema.fieldNames()
        self.tracked = [c for c in self.columns if c not in keys]
        self.open_schema = StructType([*schema.fields, StructField(HASH, StringType()), StructField(FROM, DateType())])
        self.closed_schema = StructType([*self.open_schema.fields, StructField(TO, DateType())])

    def days(self) -> list[str]:
        """The days applied, ascending (one folder each)."""
        done = [f for f in Folder(self.spark, f"{self.path}/open").children()
                if Folder(self.spark, f"{f}/_SUCCESS").exists()]
        return sorted(f.rsplit("as_of=", 1)[1] for f in done)

    def _open(self, day: str | None) -> DataFrame:
        if day is None:
            return self.spark.createDataFrame([], self.open_schema)
        return self.spark.read.schema(self.open_schema).parquet(f"{self.path}/open/as_of={day}")

    def apply(self, snapshot: DataFrame, day: str) -> None:
        """Take in the snapshot of ``day`` (YYYY-MM-DD). Rows that repeat a key count as their first in column order."""
        applied = self.days()
        if applied and day < applied[-1]:
            raise ValueError(f"the snapshot of {day} is older than that of {applied[-1]}, which is applied")
        before = max((d for d in applied if d < day), default=None)
        new = keep_best(snapshot.select(*self.columns), self.keys, []).withColumn(HASH, row_hash(self.tracked))
        o, n = self._open(before).alias("o"), new.alias("n")
        same = [F.col(f"o.{k}").eqNullSafe(F.col(f"n.{k}")) for k in self.keys]
        both = o.join(n, same, "full_outer")
        held, came = F.col(f"o.{HASH}").isNotNull(), F.col(f"n.{HASH}").isNotNull()
        kept = held & came & (F.col(f"o.{HASH}") == F.col(f"n.{HASH}"))
        today = F.lit(day).cast("date")
        pairs = both.select(
            F.when(held & ~F.coalesce(kept, F.lit(False)), F.struct("o.*")).alias("ended"),
            F.when(came, F.struct(*[F.col(f"n.{c}") for c in [*self.columns, HASH]],
                                  F.when(kept, F.col(f"o.{FROM}")).otherwise(today).alias(FROM))).alias("opened"))
        step = f"{self.path}/step/as_of={day}"
        pairs.write.mode("overwrite").parquet(step)
        pairs = self.spark.read.schema(pairs.schema).parquet(step)
        (pairs.where("ended is not null").select("ended.*").withColumn(TO, F.date_sub(today, 1))
         .write.mode("overwrite").parquet(f"{self.path}/closed/closed_on={day}"))
        pairs.where("opened is not null").select("opened.*").write.mode("overwrite").parquet(
            f"{self.path}/open/as_of={day}")
        Folder(self.spark, step).delete()

    def current(self) -> DataFrame:
        """The open versions of the last snapshot."""
        return self._open(max(self.days(), default=None)).drop(HASH)

    def versions(self) -> DataFrame:
        """All versions: the columns, ``valid_from``, ``valid_to`` (inclusive; NULL while open)."""
        days = self.days()
        out = self._open(max(days, default=None)).withColumn(TO, F.lit(None).cast("date"))
        if days:
            out = out.unionByName(self.spark.read.schema(self.closed_schema).parquet(
                *[f"{self.path}/closed/closed_on={d}" for d in days]))
        return out.drop(HASH)
