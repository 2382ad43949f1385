"""Sessions over a complete table: runs of events of one key that are never more than a gap apart."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

MICROS = 1_000_000


# Cells of one chain; longer stretches of a key are chained in parts.
CELLS_PER_CHUNK = 4096


def session_counts(df: DataFrame, key: str, ts: str, gap_seconds: int, cells_per_chunk: int = CELLS_PER_CHUNK) -> DataFrame:
    """(window_start, window_end, key, num_trips) per session; bounds are [first event, last event + gap).

    Events exactly a gap apart belong together. Two events in the same gap-wide time cell always share a session,
    so events are first summed per (key, cell), with a partial sum before the shuffle. What is left per key is
    limited by the time covered and not by the number of events. Cells are chained per (key, stretch of time), so one
    key is worked on by many tasks; only the first and last session of each stretch are then chained by key.
    """
    gap = gap_seconds * MICROS
    micros = F.unix_micros(F.col(ts).cast("timestamp"))
    cells = (
        df.where(F.col(ts).isNotNull())
        .select(F.col(key), micros.alias("at"))
        .groupBy(key, F.expr(f"(at - pmod(at, {gap}L)) div {gap}L").alias("cell"))
        .agg(F.min("at").alias("first_at"), F.max("at").alias("last_at"), F.count(F.lit(1)).alias("num_trips"))
        .withColumn("chunk", F.expr(f"(cell - pmod(cell, {cells_per_chunk}L)) div {cells_per_chunk}L"))
    )
    parts = _chained(cells, [key, "chunk"], gap)
    edge = (F.col("session") == 1) | (F.col("session") == F.col("sessions"))
    # the first and last sessions of all stretches of a key are chained together, every other one stands for itself, so
    # that one pass serves both and a key's inner sessions stay spread over the tasks
    apart = F.when(~edge, F.col("chunk") * (cells_per_chunk + 1) + F.col("session"))
    chains = _chained(parts.select(key, "first_at", "last_at", "num_trips", apart.alias("apart")), [key, "apart"], gap)
    return chains.select(
        F.timestamp_micros("first_at").alias("window_start"),
        F.timestamp_micros(F.col("last_at") + F.lit(gap)).alias("window_end"),
        key,
        "num_trips",
    )


def _chained(spans: DataFrame, keys: list[str], gap: int) -> DataFrame:
    """Spans of time (first_at, last_at, num_trips) joined where a key's next one begins at most a gap after the last,
    numbered per key as ``session``, of so many ``sessions``."""
    in_order = Window.partitionBy(*keys).orderBy("first_at")
    starts = F.coalesce(F.col("first_at") > F.lag("last_at").over(in_order) + F.lit(gap), F.lit(True))
    # both sums use the order that the lag needs, so there is one sort
    return (
        spans.withColumn("starts", starts.cast("int"))
        .withColumn("session", F.sum("starts").over(in_order.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
        .withColumn("sessions", F.sum("starts").over(in_order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)))
        .groupBy(*keys, "session")
        .agg(
            F.min("first_at").alias("first_at"), F.max("last_at").alias("last_at"), F.sum("num_trips").alias("num_trips"),
            F.max("sessions").alias("sessions"))
    )
