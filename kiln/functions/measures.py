"""Guarded ratio / money measures (half-up rounding, no divide-by-zero)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import c


def z(x) -> Column:
    """NULL -> 0."""
    return F.coalesce(c(x), F.lit(0))


def ratio(num, den, digits: int, guard: Column | None = None) -> Column:
    """round(num / den, digits); NULL when ``guard`` holds (default: den <= 0 or NULL)."""
    g = guard if guard is not None else (z(den) <= 0)
    return F.when(~g, F.round(c(num).cast("double") / c(den), digits))


def money(amount, qty) -> Column:
    """round(coalesce(amount,0) * coalesce(qty,0), 2) as double."""
    return F.round(z(amount).cast("double") * z(qty), 2)


def neg_flag(x) -> Column:
    """1 when coalesce(x, 0) < 0."""
    return F.when(z(x) < 0, F.lit(1)).otherwise(F.lit(0))


#: amounts below this go through decimal: 38 digits with 6 decimals hold 10**12 such values
DECIMAL_LIMIT = 1e20


def exact_parts(x) -> tuple[Column, Column]:
    """(decimal part, rest as double) of an amount; both can be summed and combined by ``exact_total``.

    The decimal part is the amount to 6 decimals where it is below ``DECIMAL_LIMIT``; the rest is what that leaves,
    or the whole amount beyond it. Nothing is dropped and no cast can fail.
    """
    v = c(x).cast("double")
    fits = F.abs(v) < DECIMAL_LIMIT
    part = F.when(fits, v.cast("decimal(38,6)"))
    return part, F.when(fits, v - part.cast("double")).otherwise(v)


def exact_total(part_sum, rest_sum) -> Column:
    """The sum from summed parts; NULL when there was no amount."""
    return F.coalesce(c(part_sum).cast("double"), F.lit(0.0)) + c(rest_sum)


def exact_sum(x) -> Column:
    """Sum of money-like doubles that does not depend on row order.

    Double addition is order dependent, and Spark adds partitions in whatever order tasks finish. Amounts with up to
    6 decimals are summed in decimal, so their total is reproducible run to run and cluster to cluster; smaller
    fractions and amounts beyond ``DECIMAL_LIMIT`` are added as doubles.
    """
    part, rest = exact_parts(x)
    return exact_total(F.sum(part), F.sum(rest))


def positive_part(x) -> Column:
    return F.when(c(x) > 0, c(x)).otherwise(F.lit(0))


def negative_part(x) -> Column:
    return F.when(c(x) < 0, c(x)).otherwise(F.lit(0))
