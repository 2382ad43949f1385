"""Helper shared by the column functions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def as_column(col: Column | str) -> Column:
    return F.col(col) if isinstance(col, str) else col
