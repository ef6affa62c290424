"""Bounded, reproducible training samples of labelled documents for the classifiers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def remainder(doc_id: Column, folds: int) -> Column:
    """crc32 of the decimal id modulo ``folds``; a null id has none and is never learned from."""
    return F.crc32(doc_id.cast("string").cast("binary")) % folds


def held_out(doc_id: Column, folds: int, fold: int) -> Column:
    return F.coalesce(remainder(doc_id, folds) == fold, F.lit(True))


def least_hashed(rows: DataFrame, label: str, per_class: int) -> DataFrame:
    """Of every class the ``per_class`` documents with the smallest hash of doc_id: doc_id, label, rank.

    One ranking over narrow, distinct rows serves all classes; its group limit works map-side, so no class is gathered
    in one task.
    """
    order = Window.partitionBy(label).orderBy(F.xxhash64("doc_id"), "doc_id")
    ranked = rows.select("doc_id", label).where(f"`{label}` is not null").distinct().withColumn(
        "rank", F.row_number().over(order))
    return ranked.where(F.col("rank") <= per_class)


def fetch_sample(docs: DataFrame, chosen: DataFrame, on: list[str], max_bytes: int) -> list:
    """The chosen rows with their whole texts, on the driver, by rank.

    Texts are taken rank by rank while they fit into ``max_bytes`` together; every class's first one is taken. Two
    narrow reads (the chosen ids, their sizes) come before the one that fetches texts. Of repeated ids with several
    texts the least text counts.
    """
    spark = docs.sparkSession
    ids = spark.createDataFrame(chosen.collect(), chosen.schema)      # per_class rows a class
    found = docs.join(F.broadcast(ids), on).where("text is not null")
    sizes = found.groupBy(*chosen.columns).agg(F.max(F.octet_length("text")).alias("size")).collect()
    taken, total = [], 0
    for r in sorted(sizes, key=lambda r: (r["rank"], *(str(r[c]) for c in on))):
        if total + r["size"] <= max_bytes or r["rank"] == 1:
            taken.append(tuple(r[c] for c in chosen.columns))
            total += r["size"]
    picked = spark.createDataFrame(taken, chosen.schema)
    texts = docs.join(F.broadcast(picked), on).groupBy(*chosen.columns).agg(F.min("text").alias("text")).collect()
    return sorted((r for r in texts if r["text"] is not None), key=lambda r: (r["rank"], *(str(r[c]) for c in on)))
