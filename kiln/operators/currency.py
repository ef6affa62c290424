"""Currency-safe money: totals never add amounts of two currencies; conversion uses the rate valid on the day.

A currency code is three letters after trimming and upper-casing; any other text counts as ``UNKNOWN_CURRENCY``, so the
number of codes, and with it the size of a map of totals, is bounded whatever the texts are.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.measures import exact_parts, exact_sum, exact_total
from .asof import VALID, as_of, until_next
from .sizing import SizeBook

UNKNOWN_CURRENCY = "???"
RATE_DIGITS = 6


def currency_code(x) -> Column:
    code = F.upper(F.trim(F.col(x) if isinstance(x, str) else x))
    return F.when(code.rlike("^[A-Z]{3}$"), code).otherwise(F.lit(UNKNOWN_CURRENCY))


def totals_by_currency(df: DataFrame, keys: list[str], amount: str, currency: str, total: str = "total",
                       rows: str = "n_rows", also: Sequence[Column] = ()) -> DataFrame:
    """One row per key and currency: rows, exact total and the aggregates in ``also``. Partial sums are combined map-side,
    so a hot key ships one row per task and currency."""
    part, rest = exact_parts(amount)
    return df.groupBy(*keys, currency_code(currency).alias("currency")).agg(
        F.count(F.lit(1)).alias(rows), exact_total(F.sum(part), F.sum(rest)).alias(total), *also)


def total_map(by_currency: DataFrame, keys: list[str], total: str = "total", name: str = "totals",
              also: Sequence[Column] = ()) -> DataFrame:
    """One row per key with a map currency -> total, in currency order (entries bounded by the number of codes), and the
    aggregates in ``also``. A currency without any amount has no entry."""
    entry = F.struct("currency", F.col(total).alias("total"))
    entries = F.sort_array(F.collect_list(F.when(F.col(total).isNotNull(), entry)))
    return by_currency.groupBy(*keys).agg(F.map_from_entries(entries).alias(name), *also)


def map_sum(maps: DataFrame, keys: list[str], column: str) -> DataFrame:
    """Currency maps re-aggregated to coarser keys, currency by currency."""
    rows = maps.select(*keys, F.explode(column).alias("currency", "total"))
    summed = rows.groupBy(*keys, "currency").agg(exact_sum("total").alias("total"))
    return total_map(summed, keys, "total", column)


def converted(df: DataFrame, amount: str, currency: str, day: Column, rates: DataFrame, base: str,
              stage: Callable[[DataFrame, str], DataFrame], sizes: SizeBook, output: str = "converted") -> DataFrame:
    """``output``: the amount in ``base`` by the rate valid on ``day``; NULL where no rate is.

    ``rates`` (currency, effective_date, rate: what one unit is worth in ``base``) hold until the next date of their
    currency; amounts already in ``base`` keep their value without a rate or a day. Converted amounts are rounded to
    ``RATE_DIGITS`` digits, which exact sums hold whole.
    """
    dated = rates.select(currency_code("currency").alias("k"), F.col("effective_date").cast("date").alias("start"),
                         F.col("rate").cast("double").alias("value")).where("start is not null and value is not null")
    code = currency_code(currency)
    found = as_of(df, F.when((code != base) & (code != UNKNOWN_CURRENCY), code), day, until_next(dated, ["k"], "start"),
                  stage, sizes, "__rate", "__how")
    value = F.when(code == base, F.col(amount).cast("double")).when(
        F.col("__how") == VALID, F.round(F.col(amount).cast("double") * F.col("__rate"), RATE_DIGITS))
    return found.withColumn(output, value).drop("__rate", "__how")
