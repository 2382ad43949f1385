"""Window aggregates. The tumbling functions are the same for a stream and for a complete table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from farebox.functions.times import parse_event_time
from farebox.operators.aggregates import ranked

EVENT_TIME = "event_timestamp"
LATENESS = "5 seconds"


def with_event_time(events: DataFrame, text: str = "lpep_pickup_datetime", lateness: str = LATENESS) -> DataFrame:
    """Add the event time parsed from text and, on a stream, the watermark behind it."""
    timed = events.withColumn(EVENT_TIME, parse_event_time(text))
    return timed.withWatermark(EVENT_TIME, lateness) if timed.isStreaming else timed


def _flat(grouped: DataFrame, *rest: str) -> DataFrame:
    return grouped.select(
        F.col("window.start").alias("window_start"), F.col("window.end").alias("window_end"), *rest
    )


def tumbling_counts(events: DataFrame, key: str, width: str = "5 minutes", ts: str = EVENT_TIME) -> DataFrame:
    """Trips per fixed window and key."""
    counted = events.groupBy(F.window(ts, width), key).agg(F.count(F.lit(1)).alias("num_trips"))
    return _flat(counted, key, "num_trips")


def tumbling_sums(
    events: DataFrame, value: Column | str, out: str = "total_tips", width: str = "1 hour", ts: str = EVENT_TIME
) -> DataFrame:
    """Sum of a value per fixed window, over all keys; tasks sum first, so one row per task and window moves."""
    return _flat(events.groupBy(F.window(ts, width)).agg(F.sum(value).alias(out)), out)


def session_counts_stream(events: DataFrame, key: str, gap: str = "5 minutes", ts: str = EVENT_TIME) -> DataFrame:
    """Trips per session and key on a stream; the counterpart for complete tables is ``operators.sessions``."""
    counted = events.groupBy(F.session_window(ts, gap).alias("window"), key).agg(
        F.count(F.lit(1)).alias("num_trips")
    )
    return _flat(counted, key, "num_trips")


def top_windows(results: DataFrame, by: str, n: int = 5) -> DataFrame:
    """The n best windows of a result table."""
    ties = [F.col(c) for c in results.columns if c != by]
    return ranked(results, [F.col(by).desc(), *ties], n)
