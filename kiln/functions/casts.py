"""Safe casts from dirty text.

Every cast keeps the row: text that cannot be read becomes NULL (or the
documented lenient value) instead of failing the job. ANSI mode stays on, so
only ``try_cast`` behind a regex gate is used, never a bare ``cast``.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import c, nb

# Fixed patterns (they define which texts count as numbers).
# strict integer: canonical decimal form only ('007', '+5', '-0', '12.0' are rejected)
STRICT_INT = r"^(?:0|-?[1-9][0-9]*)\z"
# lenient integer: leading digits after optional blanks and sign ('12abc' -> 12)
INT_PREFIX = r"^\s*([+-]?[0-9]+)"
# lenient real: leading decimal number with optional exponent ('1,200' -> 1)
NUM_PREFIX = r"^\s*([+-]?(?:[0-9]+\.?[0-9]*|\.[0-9]+)(?:[eE][+-]?[0-9]+)?)"
# any ASCII letter
HAS_LETTER = r"[A-Za-z]"


LARGEST, SMALLEST = (1 << 63) - 1, -(1 << 63)


def _lenient_int(x) -> Column:
    """The prefix integer (0 if none); beyond 64 bits the nearest one that fits."""
    digits = F.regexp_extract(c(x), INT_PREFIX, 1)
    beyond = F.when(digits == "", F.lit(0)).when(digits.startswith("-"), F.lit(SMALLEST)).otherwise(F.lit(LARGEST))
    return F.coalesce(digits.try_cast("bigint"), beyond.cast("bigint"))


def _lenient_real(x) -> Column:
    return F.coalesce(F.regexp_extract(c(x), NUM_PREFIX, 1).try_cast("double"), F.lit(0.0))


def strict_int(x) -> Column:
    """Integer only when the trimmed text is its own canonical form."""
    s = F.trim(c(x))
    return F.when(s.rlike(STRICT_INT), s.try_cast("bigint"))


def positive_int(x) -> Column:
    """Lenient prefix integer, kept only when > 0; blank -> NULL."""
    v = _lenient_int(x)
    return F.when(nb(x).isNotNull() & (v > 0), v)


def alpha_reject_real(x) -> Column:
    """NULL when blank or when any ASCII letter appears; else prefix real."""
    return F.when(nb(x).isNotNull() & ~F.trim(c(x)).rlike(HAS_LETTER), _lenient_real(x))


def strict_real(x) -> Column:
    """Strict variant of C3: the whole trimmed text must be a plain number."""
    s = F.trim(c(x))
    return F.when(s.rlike(r"^[+-]?(?:[0-9]+\.?[0-9]*|\.[0-9]+)\z"), s.try_cast("double"))


def positive_real(x) -> Column:
    """C4: lenient prefix real, kept only when > 0; blank -> NULL."""
    v = _lenient_real(x)
    return F.when(nb(x).isNotNull() & (v > 0), v)


def unguarded_int(x) -> Column:
    """NULL stays NULL, anything else becomes its prefix integer (0 if none)."""
    return F.when(c(x).isNotNull(), _lenient_int(x))
