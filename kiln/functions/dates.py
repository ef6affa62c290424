"""Date handling on ISO-like text.

Dates stay text through staging (invalid text passes through, as in the
source); they are parsed only inside day-difference operators.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import c, nb

MS_PER_DAY = 86_400_000
# Fixed patterns (they define which texts are instants): an ISO date with any day up to 31, optionally a time up to
# hour 24 and an offset; a time alone; a day number
_TIME = (r"(?:[01][0-9]|2[0-4]):[0-5][0-9](?::[0-5][0-9](?:\.[0-9]+)?)?\s*"
         r"(?:[+-](?:0[0-9]|1[0-4]):[0-5][0-9]\s*|[Zz]\s*)?")
ISO_INSTANT = rf"^(?:[0-9]{{4}}-(?:0[1-9]|1[0-2])-(?:0[1-9]|[12][0-9]|3[01])[\sT]*(?:{_TIME})?|{_TIME})\z"
TIME_ALONE = r"^[0-9]{2}:"
DAY_NUMBER = r"^\s*[+-]?(?:[0-9]+\.?[0-9]*|\.[0-9]+)(?:[eE][+-]?[0-9]+)?\s*\z"
PLAIN_DAY = r"^[0-9]{4}-[0-9]{2}-[0-9]{2}\z"
# parts of text that is an instant: the first hh:mm is its time, a signed one at its end the offset
CLOCK, SECONDS = r"([0-9]{2}):([0-9]{2})", r"[0-9]{2}:[0-9]{2}:([0-9]{2}(?:\.[0-9]+)?)"
OFFSET_HOURS, OFFSET_MINUTES = r"([+-][0-9]{2}):[0-9]{2}\s*\z", r"(?s)^.*([+-])[0-9]{2}:([0-9]{2})\s*\z"
#: 2000-01-01, the day of a time alone, in days since 1970
TIME_ALONE_DAY = 10957
# Julian day numbers: the last valid one, and midnight of 1970-01-01 in milliseconds
LAST_DAY_NUMBER, EPOCH_MS = 5373484.5, 210_866_760_000_000


def mdy_to_iso(x) -> Column:
    """T1: 'MM/DD/YYYY' -> 'YYYY-MM-DD' by shape; blank -> NULL; else unchanged."""
    s = c(x)
    return (F.when(s.isNull() | (F.trim(s) == ""), F.lit(None).cast("string"))
            .when(s.like("__/__/____"),
                  F.concat(F.substring(s, 7, 4), F.lit("-"), F.substring(s, 1, 2), F.lit("-"),
                           F.substring(s, 4, 2)))
            .otherwise(s))


def slash_ymd_to_iso(x) -> Column:
    """T2: 'YYYY/MM/DD' -> 'YYYY-MM-DD'; otherwise trimmed with blank -> NULL."""
    s = c(x)
    return F.when(s.like("____/__/__"), F.replace(s, F.lit("/"), F.lit("-"))).otherwise(nb(s))


def timestamp_shape(x) -> Column:
    """T4: keep text shaped like 'YYYY-MM-DD HH:MM...' (trimmed), else NULL."""
    s = c(x)
    return F.when(s.like("____-__-__ __:__%"), F.trim(s))


def _int(text: Column) -> Column:
    return F.coalesce(text.try_cast("bigint"), F.lit(0))


def _iso_ms(s: Column) -> Column:
    """Milliseconds since 1970 of text matching ``ISO_INSTANT``; day 30 or 31 of a shorter month runs into the next.

    Each part is taken from ``s`` itself: an expression used in several places is generated as often, and a method of
    generated code beyond 8000 bytes is never compiled. Text without a part gives 0 for it.
    """
    month = F.unix_date(F.concat(F.substring(s, 1, 8), F.lit("01")).try_cast("date"))
    days = F.when(s.rlike(TIME_ALONE), F.lit(TIME_ALONE_DAY)).otherwise(month + _int(F.substring(s, 9, 2)) - 1)
    hours = _int(F.regexp_extract(s, CLOCK, 1)) - _int(F.regexp_extract(s, OFFSET_HOURS, 1))
    minutes = _int(F.regexp_extract(s, CLOCK, 2)) - _int(F.regexp_replace(s, OFFSET_MINUTES, "$1$2"))
    seconds = F.coalesce(F.regexp_extract(s, SECONDS, 1).try_cast("double"), F.lit(0.0))
    return (days.cast("bigint") * MS_PER_DAY + (hours * 60 + minutes) * 60_000 + F.floor(seconds * 1000 + 0.5)).cast("bigint")


def instant_ms(x) -> Column:
    """Milliseconds since 1970-01-01 of date text; NULL when it is no instant.

    ISO dates and times (days up to 31 in any month, hour 24, offsets), times alone (on 2000-01-01) and Julian day
    numbers are read; 'now' and years before 0000 are not.
    """
    s = c(x)
    # most text is an existing day, which needs none of the patterns below
    day = F.unix_date(F.when(s.rlike(PLAIN_DAY), s.try_cast("date"))).cast("bigint") * MS_PER_DAY
    number = F.trim(F.regexp_replace(s, r"\s", "")).try_cast("double")
    other = (F.when(s.rlike(ISO_INSTANT), _iso_ms(s))
             .when(s.rlike(DAY_NUMBER), F.when((number >= 0) & (number < LAST_DAY_NUMBER),
                                               F.floor(number * MS_PER_DAY + 0.5).cast("bigint") - EPOCH_MS)))
    return F.coalesce(day, other)


def day_diff(later, earlier) -> Column:
    """T5: fractional days from ``earlier`` to ``later``; NULL if either is missing."""
    return (instant_ms(later) - instant_ms(earlier)) / F.lit(float(MS_PER_DAY))


def before_flag(later, earlier) -> Column:
    """1 when ``later`` is strictly before ``earlier`` (both present), else 0.

    The instants are compared, so that beside ``day_diff`` each of them is what both share, in a method of its own.
    """
    return F.when(instant_ms(later) < instant_ms(earlier), F.lit(1)).otherwise(F.lit(0))


def overdue_flag(status, received, requested, as_of) -> Column:
    """Open, not received, requested before the ``as_of`` instant."""
    as_of_ms = F.unix_millis(as_of.cast("timestamp")) if isinstance(as_of, Column) else instant_ms(F.lit(as_of))
    return (F.when((c(status) == "open") & c(received).isNull() & c(requested).isNotNull()
                   & (instant_ms(requested) < as_of_ms), F.lit(1))
            .otherwise(F.lit(0)))


def on_time_flag(delivered, shipped, contracted) -> Column:
    """Tri-state 1/0/NULL.

    NULL when a date or the contract is missing; otherwise 1 if the transit
    time is within the contract, else 0 (dates present but unreadable give 0).
    """
    transit = day_diff(delivered, shipped)
    return F.when(c(delivered).isNotNull() & c(shipped).isNotNull() & c(contracted).isNotNull(),
                  F.when(transit <= c(contracted), F.lit(1)).otherwise(F.lit(0)))
