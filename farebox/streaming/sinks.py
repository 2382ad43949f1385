"""Result tables kept by a stream.

Result tables are keyed by (window_start[, key]) and kept as a base of day partitions and deltas: a micro-batch writes a
delta with the windows it changed, numbered by the stream's checkpoint and the batch, so its cost follows the change and not
the day, and replaying it replaces the same delta. Read the tables by name.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

from farebox.operators.keyed import COMPACT_AFTER, GONE, compact, create_keyed, keys_of, put_delta, run_number, stored_deltas
from farebox.operators.layout import DAY

CHECKPOINT_EVERY = "10 seconds"


def create_result_table(spark: SparkSession, name: str, windows: DataFrame, keys: list[str], path: str | None = None) -> None:
    """Keyed table for the windows' columns, unless it exists."""
    fields = [f for f in windows.schema.fields if f.name != GONE]
    create_keyed(spark, name, T.StructType([*fields, T.StructField(DAY, T.DateType())]), keys, path)


def _start(writer: DataStreamWriter, checkpoint: str, available_now: bool) -> StreamingQuery:
    writer = writer.option("checkpointLocation", checkpoint)
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime=CHECKPOINT_EVERY)
    return writer.start()


def upsert_windows(
    windows: DataFrame,
    name: str,
    keys: list[str],
    checkpoint: str,
    mode: str = "append",
    available_now: bool = False,
    compact_after: int | None = COMPACT_AFTER,
) -> StreamingQuery:
    """Start the stream into a keyed result table, whose deltas are folded in when there are ``compact_after``.

    ``append`` hands over a window once, when the watermark has passed it; ``update`` hands over every change, so
    windows still open at the end are in the table too (not possible for sessions). Call ``awaitTermination()`` on
    the result: a failing stream raises there.
    """

    spark = windows.sparkSession
    if sorted(keys_of(spark, name)) != sorted(keys):
        raise ValueError(f"{name} is keyed by {keys_of(spark, name)}")
    run = run_number(spark, name, checkpoint)

    def put(batch: DataFrame, batch_id: int) -> None:
        put_delta(batch.withColumn(DAY, F.col("window_start").cast("date")), name, run, batch_id)
        if compact_after and len(stored_deltas(batch.sparkSession, name)) >= compact_after:
            compact(batch.sparkSession, name)

    return _start(windows.writeStream.outputMode(mode).foreachBatch(put), checkpoint, available_now)


def append_windows(windows: DataFrame, path: str, checkpoint: str, available_now: bool = False) -> StreamingQuery:
    """Start the stream into parquet files: each closed window is written exactly once."""
    return _start(
        windows.writeStream.outputMode("append").format("parquet").option("path", path), checkpoint, available_now
    )
