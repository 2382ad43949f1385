"""Lookup tables shipped as small CSV files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from farebox.operators.checks import assert_all, not_null, run_checks, unique
from farebox.sources.files import read_csv


def load_seed(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    not_null_columns: list[str] | None = None,
    unique_columns: list[str] | None = None,
) -> DataFrame:
    """Read a lookup CSV and refuse it when its key columns are NULL or repeated.

    The result carries no broadcast hint: Spark broadcasts it while its file stays below
    ``spark.sql.autoBroadcastJoinThreshold`` and joins by shuffling beyond that.
    """
    df = read_csv(spark, path, schema=schema, mode="FAILFAST")
    checks = [not_null(c) for c in not_null_columns or []] + [unique(c) for c in unique_columns or []]
    if checks:
        assert_all(run_checks(df, checks))
    return df
