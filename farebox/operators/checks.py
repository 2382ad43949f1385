"""Data-quality checks.

Every check yields one row (check, column, failed_rows, total_rows, passed). All row-level checks on a table are
computed in one aggregation; checks on groups or on a second table add one aggregation each.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F


class CheckFailed(Exception):
    """At least one check did not pass."""


@dataclass(frozen=True)
class RowCheck:
    """Fails for each row where ``bad`` holds."""

    name: str
    column: str
    bad: Column


@dataclass(frozen=True)
class GroupCheck:
    """Fails for each combination of ``columns`` that occurs more than once."""

    name: str
    columns: tuple[str, ...]


@dataclass(frozen=True)
class ParentCheck:
    """Fails for each row whose non-NULL ``column`` does not occur in the parent."""

    column: str
    parent: DataFrame
    parent_column: str


def not_null(column: str) -> RowCheck:
    return RowCheck("not_null", column, F.col(column).isNull())


def accepted_values(column: str, values: Iterable) -> RowCheck:
    return RowCheck("accepted_values", column, ~F.col(column).isin(list(values)))


def non_negative(column: str) -> RowCheck:
    return RowCheck("non_negative", column, F.col(column) < 0)


def positive(column: str) -> RowCheck:
    return RowCheck("positive", column, F.col(column) <= 0)


def unique(column: str) -> GroupCheck:
    return GroupCheck("unique", (column,))


def unique_combination(*columns: str) -> GroupCheck:
    return GroupCheck("unique_combination", columns)


def relationship(column: str, parent: DataFrame, parent_column: str) -> ParentCheck:
    return ParentCheck(column, parent, parent_column)


def _outcome(failed: Column, total: Column) -> list[Column]:
    return [failed.cast("long").alias("failed_rows"), total.cast("long").alias("total_rows"), (failed == 0).alias("passed")]


def _row_checks(df: DataFrame, checks: list[RowCheck]) -> DataFrame:
    counted = df.agg(
        F.count(F.lit(1)).alias("total"),
        F.array(*[
            F.struct(F.lit(c.name).alias("check"), F.lit(c.column).alias("column"), F.count_if(c.bad).alias("failed"))
            for c in checks
        ]).alias("checks"),
    )
    return counted.select("total", F.inline("checks")).select(
        "check", "column", *_outcome(F.col("failed"), F.col("total"))
    )


RESULT = "check string, column string, failed_rows long, total_rows long, passed boolean"


def watched(df: DataFrame, checks: Iterable[RowCheck | GroupCheck | ParentCheck]) -> tuple[DataFrame, Callable[[], list[tuple]]]:
    """The frame with its row checks counted while it is written, and a function for their outcomes (rows as ``RESULT``).

    Write the frame once, as it is; the outcomes are there when the write has ended. Tasks that write are counted once each,
    however often they are tried, so put nothing that shuffles behind the frame. Other checks are left out: they are run on
    what was written.
    """
    rows = [c for c in checks if isinstance(c, RowCheck)]
    if not rows:
        return df, list
    seen = Observation()
    counted = df.observe(seen, F.count(F.lit(1)).alias("total"), *[F.count_if(c.bad).alias(f"failed{i}") for i, c in enumerate(rows)])

    def outcomes() -> list[tuple]:
        found = seen.get
        return [(c.name, c.column, found[f"failed{i}"], found["total"], found[f"failed{i}"] == 0) for i, c in enumerate(rows)]

    return counted, outcomes


def _group_check(df: DataFrame, check: GroupCheck) -> DataFrame:
    rows = df.dropna(subset=list(check.columns)) if check.name == "unique" else df
    sizes = rows.groupBy(*check.columns).agg(F.count(F.lit(1)).alias("n"))
    return sizes.agg(
        F.count_if(F.col("n") > 1).alias("failed"), F.coalesce(F.sum("n"), F.lit(0)).alias("total")
    ).select(
        F.lit(check.name).alias("check"), F.lit(",".join(check.columns)).alias("column"),
        *_outcome(F.col("failed"), F.col("total")),
    )


def _parent_check(df: DataFrame, check: ParentCheck) -> DataFrame:
    # count per key first: the join then sees each child key once, however many rows carry it
    keys = df.where(F.col(check.column).isNotNull()).groupBy(F.col(check.column).alias("key")).agg(
        F.count(F.lit(1)).alias("n")
    )
    known = check.parent.select(F.col(check.parent_column).alias("key")).distinct().withColumn("known", F.lit(True))
    return keys.join(known, "key", "left").agg(
        F.coalesce(F.sum(F.when(F.col("known").isNull(), F.col("n"))), F.lit(0)).alias("failed"),
        F.coalesce(F.sum("n"), F.lit(0)).alias("total"),
    ).select(
        F.lit("relationships").alias("check"), F.lit(check.column).alias("column"),
        *_outcome(F.col("failed"), F.col("total")),
    )


def run_checks(df: DataFrame, checks: Iterable[RowCheck | GroupCheck | ParentCheck]) -> DataFrame:
    """One result row per check."""
    checks = list(checks)
    rows = [c for c in checks if isinstance(c, RowCheck)]
    frames = [_row_checks(df, rows)] if rows else []
    frames += [_group_check(df, c) for c in checks if isinstance(c, GroupCheck)]
    frames += [_parent_check(df, c) for c in checks if isinstance(c, ParentCheck)]
    return reduce(DataFrame.unionByName, frames)


def run_other_checks(df: DataFrame, checks: Iterable[RowCheck | GroupCheck | ParentCheck]) -> list[tuple]:
    """Outcomes (rows as ``RESULT``) of the checks that ``watched`` leaves out."""
    others = [c for c in checks if not isinstance(c, RowCheck)]
    return [tuple(r) for r in run_checks(df, others).collect()] if others else []


def scalar_equals(name: str, scalar: DataFrame, expected) -> DataFrame:
    """A query's single value against an expected one; failed_rows is 1 when they differ."""
    value = F.col(scalar.columns[0])
    failed = F.when(value.eqNullSafe(F.lit(expected)), 0).otherwise(1)
    return scalar.select(F.lit(name).alias("check"), F.lit(scalar.columns[0]).alias("column"), *_outcome(failed, F.lit(1)))


def duplicate_count(df: DataFrame, column: str) -> DataFrame:
    """Rows minus distinct values of the column, as ``duplicates``."""
    return df.agg((F.count(F.lit(1)) - F.count_distinct(column)).alias("duplicates"))


def freshness(
    df: DataFrame, loaded_at: str, now: str, warn_hours: int = 24, error_hours: int = 48
) -> DataFrame:
    """Age of the newest row against two limits: status pass, warn or error."""
    now_col = F.lit(now).cast("timestamp_ntz")
    newest = df.agg(F.max(F.col(loaded_at).cast("timestamp_ntz")).alias("newest"))
    age = F.timestamp_diff("SECOND", F.col("newest"), now_col) / F.lit(3600.0)
    status = (
        F.when(F.col("newest").isNull() | (age > error_hours), "error").when(age > warn_hours, "warn").otherwise("pass")
    )
    return newest.select(
        F.lit("freshness").alias("check"), F.lit(loaded_at).alias("column"), "newest",
        F.round(age, 2).alias("age_hours"), status.alias("status"), (status != "error").alias("passed"),
    )


def assert_all(results: DataFrame) -> None:
    """Raise when any check failed; the result has one row per check, so collecting it is bounded."""
    failed = results.where(~F.col("passed")).collect()
    if failed:
        raise CheckFailed("; ".join(f"{r['check']}({r['column']})" for r in failed))
