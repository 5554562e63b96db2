"""Data tests. Each returns the failing rows or keys; an empty result is a pass."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from ledgerwake.operators.sets import union_all


@dataclass(frozen=True)
class Check:
    """One declared test. ``rule`` is a predicate on the column, e.g. ``> 0``."""

    model: str
    column: str
    kind: str
    values: tuple[str, ...] = ()
    rule: str = ""

    def breaks(self) -> str:
        """SQL predicate that is true for a row that fails (row-level kinds only)."""
        column = f"`{self.column}`"
        if self.kind == "not_null":
            return f"{column} IS NULL"
        if self.kind == "accepted_values":
            return f"{column} NOT IN ({', '.join(map(_literal, self.values))})"
        if self.kind == "expression_is_true":
            return f"NOT ({column} {self.rule})"
        raise ValueError(f"not a row-level check: {self.kind}")

    def summary(self, failures: str) -> str:
        """SQL struct that reports ``failures`` for this check."""
        return (f"named_struct('model', {_literal(self.model)}, "
                f"'column_name', {_literal(self.column)}, 'kind', {_literal(self.kind)}, "
                f"'failures', {failures})")


def _literal(text: str) -> str:
    escaped = text.replace("\\", "\\\\").replace("'", "\\'")
    return f"'{escaped}'"


def not_null(df: DataFrame, column: str) -> DataFrame:
    return df.filter(F.col(column).isNull())


def unique(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Keys held by more than one row, with their row count. NULL keys are ignored."""
    return (
        df.select(*columns).na.drop(subset=list(columns))
        .groupBy(*columns).agg(F.count(F.lit(1)).alias("n_rows"))
        .filter(F.col("n_rows") > 1)
    )


def accepted(df: DataFrame, column: str, values: Sequence[str]) -> DataFrame:
    return df.filter(~F.col(column).isin(*values))


def holds(df: DataFrame, expression: str) -> DataFrame:
    return df.filter(~F.expr(expression))


@dataclass(frozen=True)
class Observed:
    """Row-level checks of one model that are counted while its rows pass by."""

    checks: tuple[Check, ...]
    counts: Observation

    def failures(self) -> dict[Check, int]:
        """Wait for the job that the rows pass through, and give its counts.

        From a plan that it proves to have no rows, Spark drops the counting and cannot turn its
        empty result into a row; nothing fails there.
        """
        try:
            found = self.counts.get
        except Py4JJavaError as error:
            if "toPyRow" not in str(error):
                raise
            found = {f"c{i}": 0 for i in range(len(self.checks))}
        return {check: found[f"c{i}"] for i, check in enumerate(self.checks)}


def observed(df: DataFrame, checks: Iterable[Check]) -> tuple[DataFrame, Observed | None]:
    """``df`` with its row-level checks counted by the first job that runs it.

    The counts come out of a job that writes the rows, or a table made of them, so they cost no
    scan of their own. If Spark has to repeat finished tasks of a lost executor, their failures
    are counted again; no failure stays none.
    """
    own = tuple(check for check in checks if check.kind != "unique")
    if not own:
        return df, None
    counts = Observation()
    return df.observe(counts, *[
        F.expr(f"count_if({check.breaks()})").alias(f"c{i}") for i, check in enumerate(own)
    ]), Observed(own, counts)


def _row_level(df: DataFrame, checks: Sequence[Check]) -> DataFrame:
    """All row-level checks of one model in a single pass and a one-row result.

    SQL text rather than columns: a suite has hundreds of small expressions, and each
    column object costs a round trip to the JVM.
    """
    totals = df.selectExpr(*[
        f"count_if({check.breaks()}) AS c{i}" for i, check in enumerate(checks)])
    rows = ", ".join(check.summary(f"c{i}") for i, check in enumerate(checks))
    return totals.selectExpr(f"inline(array({rows}))")


def _unique(models: Mapping[str, DataFrame], checks: Sequence[Check]) -> DataFrame:
    """All unique checks of one key column, over whichever models, by one grouping of the key."""
    column = checks[0].column
    keys = union_all([
        models[check.model].select(F.col(column).alias("key"), F.lit(i).alias("model"))
        for i, check in enumerate(checks)]).filter("key IS NOT NULL")
    held = keys.groupBy("key").agg(*[
        F.count_if(F.col("model") == i).alias(f"n{i}") for i in range(len(checks))])
    repeated = held.selectExpr(*[f"count_if(n{i} > 1) AS c{i}" for i in range(len(checks))])
    rows = ", ".join(check.summary(f"c{i}") for i, check in enumerate(checks))
    return repeated.selectExpr(f"inline(array({rows}))")


def run_checks(
    models: Mapping[str, DataFrame], checks: Iterable[Check],
    counted: Mapping[Check, int] | None = None,
) -> DataFrame:
    """One row per check: model, column, kind and number of failures.

    Checks in ``counted`` have been counted while their model was written. Of the others, all
    row-level checks of a model are one scan without a shuffle, and all unique checks of a key
    column one shuffle of that column, however many models hold it.
    """
    counted = counted or {}
    checks = list(checks)
    open_ = [check for check in checks if check not in counted]
    parts = []
    for model in dict.fromkeys(check.model for check in open_):
        by_row = [check for check in open_ if check.model == model and check.kind != "unique"]
        if by_row:
            parts.append(_row_level(models[model], by_row))
    unique_ = [check for check in open_ if check.kind == "unique"]
    for column in dict.fromkeys(check.column for check in unique_):
        parts.append(_unique(models, [check for check in unique_ if check.column == column]))
    known = ", ".join(
        check.summary(f"{counted[check]}L") for check in checks if check in counted)
    if known:
        spark = next(iter(models.values())).sparkSession
        parts.append(spark.range(1).selectExpr(f"inline(array({known}))"))
    return union_all(parts)
