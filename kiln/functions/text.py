"""Text cleaning expressions (Column -> Column, no DataFrame state)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def t(x) -> Column:
    """Trim spaces on both sides (spaces only; tabs are kept)."""
    return F.trim(c(x))


def nb(x) -> Column:
    """Trimmed text with blank turned into NULL."""
    return F.nullif(F.trim(c(x)), F.lit(""))


def upper_code(x) -> Column:
    return F.upper(F.trim(c(x)))


def lower_code(x) -> Column:
    return F.lower(F.trim(c(x)))


def y_flag(x) -> Column:
    """1 when the trimmed text is Y/y, else 0 (NULL counts as 0)."""
    return F.when(F.upper(F.trim(c(x))) == "Y", F.lit(1)).otherwise(F.lit(0))


def tier(x) -> Column:
    """Customer tier canonical form; unknown non-blank spellings pass through trimmed."""
    squashed = F.lower(F.regexp_replace(F.trim(c(x)), "[- ]", ""))
    return (F.when(squashed == "tier1", F.lit("Tier 1"))
            .when(squashed == "tier2", F.lit("Tier 2"))
            .when(squashed == "tier3", F.lit("Tier 3"))
            .when(F.lower(F.trim(c(x))) == "strategic", F.lit("Strategic"))
            .otherwise(nb(x)))


def warehouse_type(x) -> Column:
    """Warehouse type canonical form; blank/UNKNOWN -> NULL, others trimmed."""
    u = F.upper(F.trim(c(x)))
    return (F.when(u.isin("DISTRIBUTION CENTER", "DC"), F.lit("Distribution Center"))
            .when(u == "3PL", F.lit("3PL"))
            .when(nb(x).isNull() | (u == "UNKNOWN"), F.lit(None).cast("string"))
            .otherwise(F.trim(c(x))))


def record_key(*parts) -> Column:
    """Composite id ``a|b|c``; NULL if any part is NULL (null-propagating concat)."""
    pieces = []
    for i, p in enumerate(parts):
        if i:
            pieces.append(F.lit("|"))
        pieces.append(c(p).cast("string"))
    return F.concat(*pieces)


def or_null_text(x) -> Column:
    """Render a value for a message: its text, or the word NULL."""
    return F.coalesce(c(x).cast("string"), F.lit("NULL"))
