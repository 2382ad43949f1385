"""Collects queries and their SQL forms under one key."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from farebox.session import pin_settings

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def plain_types(df: DataFrame) -> DataFrame:
    """Result types both engines share: wall-clock timestamps, doubles for decimals with all their places."""
    changes = {}
    for field in df.schema.fields:
        kind = field.dataType.typeName()
        if kind == "timestamp":
            changes[field.name] = F.col(field.name).cast("timestamp_ntz")
        elif kind == "decimal":
            changes[field.name] = F.col(field.name).cast("double")
    return df.withColumns(changes) if changes else df


def register(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Register ``fn(spark, sf_dir)``; ``sql`` is its form for the SQL engine, or None for a rows-only check."""

    def wrap(fn: Query) -> Query:
        @wraps(fn)
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return plain_types(fn(pin_settings(spark), sf_dir.rstrip("/")))

        if name in QUERIES:
            raise ValueError(f"query {name} registered twice")
        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return wrap


def cents(expr: str) -> str:
    """SQL text: exact amount of cents as double."""
    return f"cast(cast({expr} as decimal(18,2)) as double)"
