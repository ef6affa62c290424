"""Data-quality findings as ordinary rows.

A rule is (issue_type, condition, record_id, offending_value, description)
over one source table. All rules over the same table are evaluated in a
single pass: rows that raise any finding are selected first (flag filters
reach the file scan), each builds an array of its findings (NULL where a rule
does not hold) and the array is exploded and stripped of NULLs, so a table with
nine rules is scanned once, not nine times. The array is built and exploded in
generated code; a filter function over it would evaluate it by interpretation.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

FINDING_COLUMNS = ["source_model", "issue_type", "record_id", "offending_value", "description"]

# Data-quality policy vocabulary (how a finding is handled upstream).
POLICIES = ("fix_silently", "coerce_and_flag", "preserve_and_flag", "quarantine", "document",
            "flag_dont_resolve")


@dataclass(frozen=True)
class Rule:
    source_model: str
    issue_type: str
    condition: Column
    record_id: Column
    description: Column
    offending_value: Column | None = None
    policy: str = "preserve_and_flag"


def _finding(rule: Rule) -> Column:
    off = rule.offending_value if rule.offending_value is not None else F.lit(None)
    return F.when(rule.condition, F.struct(
        F.lit(rule.source_model).alias("source_model"),
        F.lit(rule.issue_type).alias("issue_type"),
        rule.record_id.cast("string").alias("record_id"),
        off.cast("string").alias("offending_value"),
        rule.description.cast("string").alias("description")))


def evaluate(df: DataFrame, rules: list[Rule], with_offending: bool = True) -> DataFrame:
    """All findings of ``rules`` over one table, one scan of the rows that any rule flags."""
    flagged = df.where(reduce(Column.__or__, [r.condition for r in rules]))
    cols = FINDING_COLUMNS if with_offending else [c for c in FINDING_COLUMNS if c != "offending_value"]
    found = flagged.select(F.explode(F.array(*[_finding(r) for r in rules])).alias("f")).where(F.col("f").isNotNull())
    return found.select(*[F.col(f"f.{c}").alias(c) for c in cols])


def union_all(frames: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)
