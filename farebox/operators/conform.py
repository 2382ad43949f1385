"""Bring differently shaped feeds to one set of columns."""

from __future__ import annotations

from collections.abc import Collection

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from farebox.functions.columns import as_column
from farebox.schemas import INGEST_INTEGERS, INGEST_KEEP, INGEST_RENAMES, Field


def to_contract(
    df: DataFrame, contract: list[Field], required: str | None = None, uncast: Collection[str] = ()
) -> DataFrame:
    """Select, rename and cast to the contract; rows whose ``required`` source column is NULL are left out.

    Columns of ``uncast`` that the feed has as doubles stay doubles, for a model that drops rows before it casts.
    """
    if required:
        df = df.where(F.col(required).isNotNull())

    def field(f: Field) -> Column:
        if f.name in uncast and df.schema[f.source].dataType.typeName() == "double":
            return F.col(f.source)
        return F.col(f.source).try_cast(f.dtype) if f.safe else F.col(f.source).cast(f.dtype)

    return df.select(*[field(f).alias(f.name) for f in contract])


def keep_existing(df: DataFrame, names: list[str]) -> DataFrame:
    """The listed columns the frame has, in the listed order."""
    present = {c.lower() for c in df.columns}
    return df.select(*[n for n in names if n.lower() in present])


def with_constants(df: DataFrame, **values: Column) -> DataFrame:
    """Add constant columns that align two schemas."""
    return df.withColumns(values)


def nullable_integer(col: Column | str, dtype: str = "int") -> Column:
    """Integer, with NaN and everything unreadable as NULL."""
    return as_column(col).try_cast(dtype)


def drop_zone(df: DataFrame) -> DataFrame:
    """Zoned timestamps to wall-clock ones (UTC is pinned, so the shown time stays)."""
    zoned = [f.name for f in df.schema.fields if f.dataType.typeName() == "timestamp"]
    return df.withColumns({c: F.col(c).cast("timestamp_ntz") for c in zoned})


def ingest_shape(df: DataFrame, taxi_type: str, extracted_at: Column, keep: tuple[str, ...] = ()) -> DataFrame:
    """Raw month rows to the columns of the ingestion table.

    Pickup and drop-off are named differently per taxi type; only listed columns that exist, and those of ``keep``, are
    kept. NaN is NULL.
    """
    prefix = "tpep" if taxi_type == "yellow" else "lpep"
    df = df.withColumnsRenamed({
        f"{prefix}_pickup_datetime": "pickup_datetime",
        f"{prefix}_dropoff_datetime": "dropoff_datetime",
    })
    df = drop_zone(keep_existing(df, [*INGEST_KEEP, *keep])).withColumnsRenamed(INGEST_RENAMES)
    df = df.withColumns({c: nullable_integer(c) for c in INGEST_INTEGERS if c in df.columns})
    doubles = [f.name for f in df.schema.fields if f.dataType.typeName() == "double"]
    df = df.withColumns({c: F.nanvl(c, F.lit(None).cast("double")) for c in doubles})
    return with_constants(df, taxi_type=F.lit(taxi_type), extracted_at=extracted_at)
