"""What the operators share: columns computed in Arrow batches, tables in the shared folder, ordered keys."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from farebox.session import scratch_path

# Rows handed to Python at a time; with long texts Spark's limit on the bytes of a batch acts first.
BATCH_ROWS = 512
BATCH_BYTES = 16 << 20


def small_batches(spark: SparkSession) -> None:
    """Bound the Arrow batches of text columns; called by every operator that hands texts to Python."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))


def without(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """``df`` without the columns of these names in any letter case: results replace columns of the same name."""
    taken = {n.lower() for n in names}
    return df.select(*[df[f"`{c}`"] for c in df.columns if c.lower() not in taken])


def spare_names(df: DataFrame, n: int) -> list[str]:
    """Names that no column of ``df`` has, in any letter case."""
    longest = max((len(c) for c in df.columns), default=0)
    return [f"{'_' * (longest + 1)}{i}" for i in range(n)]


def own_columns(df: DataFrame, like: DataFrame | None = None) -> list[Column]:
    """All columns of ``df`` (or those that ``like`` has), whatever characters their names hold."""
    return [df[f"`{c}`"] for c in (like or df).columns]


def with_python_columns(
    df: DataFrame, inputs: Sequence[str], outputs: str | T.StructType,
    make: Callable[[], Callable[..., Sequence[Sequence]]],
) -> DataFrame:
    """``df`` with columns computed in Python from the columns ``inputs``, batch by batch and without a shuffle.

    ``make()`` runs once per task and returns the function that takes one list per input and returns one list (or
    Arrow array) per output. Outputs replace columns of the same name; all other columns pass through as Arrow data.
    """
    small_batches(df.sparkSession)
    added = T._parse_datatype_string(outputs) if isinstance(outputs, str) else outputs
    rest = without(df, added.names)
    # numbered on the way, because the names may hold any character
    kept, arrow = len(rest.columns), to_arrow_schema(added)
    sent = df.select(
        *[df[f"`{c}`"].alias(f"kept{i}") for i, c in enumerate(rest.columns)], *[df[f"`{c}`"].alias(f"in{i}") for i, c in enumerate(inputs)])
    back = T.StructType([
        *[T.StructField(f"kept{i}", f.dataType) for i, f in enumerate(rest.schema.fields)],
        *[T.StructField(f"new{i}", f.dataType) for i, f in enumerate(added.fields)]])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        compute = make()
        for batch in batches:
            columns = compute(*[batch.column(kept + i).to_pylist() for i in range(len(inputs))])
            new = [c if isinstance(c, pa.Array) else pa.array(c, f.type) for c, f in zip(columns, arrow, strict=True)]
            yield pa.RecordBatch.from_arrays([*batch.columns[:kept], *new], names=back.names)

    named = zip(back.names, [*rest.columns, *added.names])
    return sent.mapInArrow(run, back).select(*[F.col(n).alias(name) for n, name in named])


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to a fresh folder below spark.checkpoint.dir and read it back: a cut in the lineage that every
    executor can read after any loss."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
