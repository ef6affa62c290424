"""Column expressions: text, safe casts, dates, measures."""

from . import casts, dates, measures, text  # noqa: F401
