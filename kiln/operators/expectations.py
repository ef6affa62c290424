"""Declarative expectations evaluated as DataFrames of failure counts.

Four kinds: not_null, unique, accepted_values, relationships (optionally
scoped by a ``where`` filter). A suite reads every table once: each row emits
the few (check, value) facts its checks need (a missing value, an unexpected
value, a key, a parent's key), which are counted by (check, value) and then
by check. Both counts combine map-side, so hot keys are no hot tasks, and a
relationship is a count of child and parent facts instead of a join.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

RESULT_COLUMNS = ["model_name", "column_name", "test_name", "failures"]


@dataclass(frozen=True)
class NotNull:
    model: str
    column: str
    name: str = "not_null"


@dataclass(frozen=True)
class Unique:
    model: str
    column: str
    name: str = "unique"


@dataclass(frozen=True)
class AcceptedValues:
    model: str
    column: str
    values: tuple
    name: str = "accepted_values"


@dataclass(frozen=True)
class Relationship:
    model: str
    column: str
    to_model: str
    to_column: str
    where: str | None = None
    name: str = "relationships"


@dataclass
class Suite:
    checks: list = field(default_factory=list)

    def by_model(self):
        out: dict[str, list] = {}
        for ck in self.checks:
            out.setdefault(ck.model, []).append(ck)
        return out


def suite_models(suite: Suite) -> list[str]:
    """The tables that a suite reads, as child or parent."""
    return list(dict.fromkeys(n for ck in suite.checks for n in (ck.model, getattr(ck, "to_model", None)) if n))


def _child_facts(k: int, ck) -> tuple[Column, Column]:
    """Whether one row contributes to check ``k``, and the fact that it contributes."""
    col = F.col(ck.column)
    if isinstance(ck, NotNull):
        emits, value = col.isNull(), F.lit(None)
    elif isinstance(ck, AcceptedValues):
        emits, value = col.isNotNull() & ~col.isin(*ck.values), col
    else:
        emits, value = col.isNotNull(), col
        if isinstance(ck, Relationship) and ck.where:
            emits = emits & F.expr(ck.where)
    return emits, _fact(k, value, 1, 0)


def _fact(k: int, value: Column, child: int, parent: int) -> Column:
    return F.struct(F.lit(k).alias("k"), value.cast("string").alias("value"), F.lit(child).cast("bigint").alias("n"),
                    F.lit(parent).cast("bigint").alias("parents"))


def _facts(tables: dict[str, DataFrame], checks: list) -> DataFrame:
    """One pass over every table that a check reads, as child or as parent.

    Rows without any fact are filtered first, by conditions that reach the scan; the facts are built, exploded and
    stripped of NULLs in generated code (a filter function over the array would be interpreted).
    """
    by_table: dict[str, list[tuple[Column, Column]]] = {}
    for k, ck in enumerate(checks):
        by_table.setdefault(ck.model, []).append(_child_facts(k, ck))
        if isinstance(ck, Relationship):
            key = F.col(ck.to_column)
            by_table.setdefault(ck.to_model, []).append((key.isNotNull(), _fact(k, key, 0, 1)))
    parts = [tables[name].where(reduce(Column.__or__, [emits for emits, _ in facts]))
             .select(F.explode(F.array(*[F.when(emits, fact) for emits, fact in facts])).alias("f"))
             .where(F.col("f").isNotNull()).select("f.*") for name, facts in by_table.items()]
    return reduce(DataFrame.union, parts)


def run(tables: dict[str, DataFrame], suite: Suite) -> DataFrame:
    """One row per check: model, column, test, number of failures (0 = pass).

    not_null and relationships count rows; unique and accepted_values count distinct offending values.
    """
    checks = suite.checks
    spark = next(iter(tables.values())).sparkSession
    listed = [F.struct(*[F.lit(v).alias(n) for n, v in
                         (("k", k), ("model_name", ck.model), ("column_name", ck.column), ("test_name", ck.name))])
              for k, ck in enumerate(checks)]
    names = spark.range(1).select(F.inline(F.array(*listed)))
    kinds = [[k for k, ck in enumerate(checks) if isinstance(ck, kind)]
             for kind in (NotNull, Unique, AcceptedValues, Relationship)]
    is_kind = [F.col("k").isin(*ks) if ks else F.lit(False) for ks in kinds]
    by_value = _facts(tables, checks).groupBy("k", "value").agg(F.sum("n").alias("n"), F.sum("parents").alias("parents"))
    failures = (F.when(is_kind[0], F.col("n")).when(is_kind[1], (F.col("n") > 1).cast("bigint"))
                .when(is_kind[2], F.lit(1).cast("bigint"))
                .when(is_kind[3], F.when(F.col("parents") == 0, F.col("n")).otherwise(F.lit(0))))
    counted = by_value.groupBy("k").agg(F.sum(failures).alias("failures"))
    # the list of checks is bounded by the suite
    return names.join(F.broadcast(counted), "k", "left").select("model_name", "column_name", "test_name",
                F.coalesce("failures", F.lit(0).cast("bigint")).alias("failures"))


class ExpectationError(AssertionError):
    """Some expectations failed; ``failures`` lists (model, column, test, failing count)."""

    def __init__(self, failures: list[tuple]):
        self.failures = failures
        super().__init__("; ".join(f"{m}.{c} {t}: {n}" for m, c, t, n in failures))


def enforce(results: DataFrame) -> None:
    """Raise ``ExpectationError`` unless every check passed (reads one row per check)."""
    failed = [tuple(r) for r in results.where(F.col("failures") > 0).select(*RESULT_COLUMNS).collect()]
    if failed:
        raise ExpectationError(sorted(failed))


def failing_rows(tables: dict[str, DataFrame], ck) -> DataFrame:
    """The offending rows of one check (for drill-down)."""
    df = tables[ck.model]
    if isinstance(ck, NotNull):
        return df.where(F.col(ck.column).isNull())
    if isinstance(ck, AcceptedValues):
        return df.where(F.col(ck.column).isNotNull() & ~F.col(ck.column).isin(*ck.values))
    if isinstance(ck, Unique):
        return df.where(F.col(ck.column).isNotNull()).groupBy(ck.column).count().where("count > 1")
    child = df.where(F.expr(ck.where)) if ck.where else df
    par = tables[ck.to_model].select(F.col(ck.to_column).alias("__p"))
    return child.where(F.col(ck.column).isNotNull()).join(par, F.col(ck.column) == par["__p"], "left_anti")
