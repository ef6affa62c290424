"""Surrogate keys: dense numbers for natural keys that stay the same over reruns.

Every assignment numbers only the natural keys that have no number yet, after the highest one given, in natural-key
order (``number_rows``: range partitions and prefix sums, no single-task sort). Each assignment is a folder of its own
below ``path``; one that died before its folder was complete is written again with the same numbers, because they
depend on the natural keys and the folders before it only.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from ..operators.numbering import number_rows
from .upsert import Folder


class SurrogateKeys:
    """Numbers from 1 on in column ``name`` for the distinct values of ``keys`` (any of them may be NULL)."""

    def __init__(self, spark: SparkSession, path: str, schema: StructType, keys: list[str], name: str = "surrogate_key"):
        self.spark, self.path, self.keys, self.name = spark, path.rstrip("/"), keys, name
        self.schema = StructType([*[schema[k] for k in keys], StructField(name, LongType())])

    def _folders(self) -> list[str]:
        return [f for f in Folder(self.spark, self.path).children() if Folder(self.spark, f"{f}/_SUCCESS").exists()]

    def read(self) -> DataFrame:
        folders = self._folders()
        if not folders:
            return self.spark.createDataFrame([], self.schema)
        return self.spark.read.schema(self.schema).parquet(*folders)

    def assign(self, df: DataFrame, stage: Callable[[DataFrame, str], DataFrame]) -> DataFrame:
        """Give numbers to the keys of ``df`` that have none; all numbers given so far."""
        given = self.read()
        last = given.agg(F.coalesce(F.max(self.name), F.lit(0))).first()[0]
        same = [F.col(f"n.{k}").eqNullSafe(F.col(f"g.{k}")) for k in self.keys]
        new = df.select(*self.keys).distinct().alias("n").join(given.alias("g"), same, "left_anti")
        numbered = number_rows(new, self.keys, stage, self.name, first=last + 1)
        numbered.withColumn(self.name, F.col(self.name).cast("long")).write.mode("overwrite").parquet(
            f"{self.path}/{len(self._folders()):06d}")
        return self.read()

    def collisions(self) -> DataFrame:
        """Natural keys with several numbers and numbers with several natural keys (empty when all is well)."""
        pairs = self.read()
        by_key = pairs.groupBy(*self.keys).agg(F.count(F.lit(1)).alias("n"), F.min(self.name).alias(self.name))
        by_number = pairs.groupBy(self.name).agg(F.count(F.lit(1)).alias("n"), *[F.min(k).alias(k) for k in self.keys])
        columns = [*self.keys, self.name, "n"]
        return by_key.where("n > 1").select(*columns).unionByName(by_number.where("n > 1").select(*columns))
