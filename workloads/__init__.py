"""The engine's queries over the driver tables, each with an independent SQL form where SQL can say it."""

from workloads import (
    aggregates,
    analytics,
    checks,
    functions,
    joins,
    models,
    projections,
    sets_and_sorts,
    sources,
    streams,
    tables,
    windows,
)
from workloads.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
