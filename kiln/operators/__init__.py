"""Reusable DataFrame operators."""

from . import dedup, expectations, findings, keys, mapping, resolve, scd  # noqa: F401
