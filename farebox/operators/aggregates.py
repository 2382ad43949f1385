"""Aggregates that need more than one built-in call."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from farebox.functions.columns import as_column


def share_of_total(df: DataFrame, key: str, out: str = "pct") -> DataFrame:
    """Rows per key and their percentage of all rows, rounded to two decimals.

    The total is a scalar subquery over the same aggregate (Spark reuses its exchange), so even a key with very
    many values never passes through a single-task window.
    """
    counts = df.groupBy(key).agg(F.count(F.lit(1)).alias("trips"))
    total = counts.agg(F.sum("trips").cast("double")).scalar()
    return counts.withColumn(out, F.round(F.col("trips") * F.lit(100.0) / total, 2))


def ranked(df: DataFrame, order: list[Column], n: int | None = None) -> DataFrame:
    """Sorted rows, or the first ``n`` of them: each task keeps only its own best ``n``."""
    ordered = df.orderBy(*order)
    return ordered if n is None else ordered.limit(n)


def load_report(df: DataFrame, unit: list[str]) -> DataFrame:
    """Rows per loaded unit with a running total in unit order.

    Units are summed up within each value of the first column, by a task per value. Only those values' totals (months or
    kinds) run through one window; they are added to the running totals within. NULL is a value and comes first.
    """
    first, *rest = unit
    counts = df.groupBy(*unit).agg(F.count(F.lit(1)).alias("row_count"))
    totals = counts.groupBy(F.col(first).alias("_first")).agg(F.sum("row_count").alias("_rows"))
    earlier = Window.orderBy("_first").rowsBetween(Window.unboundedPreceding, -1)
    before = totals.select("_first", F.coalesce(F.sum("_rows").over(earlier), F.lit(0)).alias("_before"))
    within = Window.partitionBy(first).orderBy(*rest or [first]).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    running = counts.withColumn("_within", F.sum("row_count").over(within))
    return running.join(before, F.col(first).eqNullSafe(F.col("_first"))).select(
        *unit, "row_count", (F.col("_before") + F.col("_within")).alias("running_rows"))


def money(col: Column | str, dtype: str = "decimal(18,2)") -> Column:
    """Exact sum of an amount in cents, independent of row order."""
    return F.sum(as_column(col).cast(dtype))
