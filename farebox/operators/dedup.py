"""Keep one row per key."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def keep_one(df: DataFrame, keys: list[Column | str], order: list[Column], tie_break: list[str] | None = None) -> DataFrame:
    """First row per key in ``order``; ties are settled by ``tie_break`` (default: all other columns).

    The ``= 1`` filter sits directly on the window, so each task keeps one row per key before the shuffle:
    a key holding a third of the table sends one row per task, not its rows. Rows are sorted by the keys as
    listed; put the column with the most values first, its prefix then decides most comparisons.
    """
    if tie_break is None:
        names = {k for k in keys if isinstance(k, str)}
        tie_break = [
            f.name for f in df.schema.fields if f.name not in names and f.dataType.typeName() not in ("map", "variant")
        ]
    window = Window.partitionBy(*keys).orderBy(*order, *[F.col(c).asc_nulls_last() for c in tie_break])
    return df.withColumn("_position", F.row_number().over(window)).where("_position = 1").drop("_position")


def keep_first(df: DataFrame, keys: list[Column | str], by: str, tie_break: list[str] | None = None) -> DataFrame:
    return keep_one(df, keys, [F.col(by).asc_nulls_last()], tie_break)


def keep_latest(df: DataFrame, keys: list[Column | str], by: str, tie_break: list[str] | None = None) -> DataFrame:
    return keep_one(df, keys, [F.col(by).desc_nulls_last()], tie_break)
