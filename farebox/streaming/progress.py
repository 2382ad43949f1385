"""What a running stream has seen: counters per micro-batch with running totals, and an end when nothing comes any more."""

from __future__ import annotations

import time
from collections.abc import Callable

from pyspark.sql import DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

from farebox.sources.events import is_long_trip

STEP = "batch_id long, messages long, long_trips long"


class IdleClock(StreamingQueryListener):
    """Hears of every micro-batch of the stream of this name and knows how long ago the last input came."""

    def __init__(self, name: str, clock: Callable[[], float] = time.monotonic):
        self.name, self.clock = name, clock
        self.last_input: float | None = None
        self.idle_events = 0

    def onQueryStarted(self, event) -> None:
        if event.name == self.name:
            self.last_input = self.clock()

    def onQueryProgress(self, event) -> None:
        if event.progress.name == self.name and event.progress.numInputRows:
            self.last_input = self.clock()

    def onQueryIdle(self, event) -> None:
        self.idle_events += 1

    def onQueryTerminated(self, event) -> None:
        pass

    def idle_for(self) -> float:
        """Seconds since the last micro-batch with input, or since the start."""
        return 0.0 if self.last_input is None else self.clock() - self.last_input


def keep_counters(path: str, column: str, above: float) -> Callable[[DataFrame, int], None]:
    """A ``foreachBatch`` function that observes a micro-batch's messages and long trips in one pass over it and stores them
    below ``path`` under the batch's number, before the batch counts as done: repeating a batch replaces its row, so the
    counters are exact after any restart."""

    def keep(batch: DataFrame, batch_id: int) -> None:
        seen = Observation()
        batch.observe(
            seen, F.count(F.lit(1)).alias("messages"), F.count_if(is_long_trip(column, above)).alias("long_trips")
        ).write.format("noop").mode("overwrite").save()
        step = [(batch_id, seen.get["messages"], seen.get["long_trips"])]
        batch.sparkSession.createDataFrame(step, STEP).coalesce(1).write.mode("overwrite").parquet(f"{path}/batch={batch_id}")

    return keep


def read_counters(spark: SparkSession, path: str) -> DataFrame:
    """``batch_id``, ``messages``, ``long_trips`` of every micro-batch, and the totals up to it.

    One row per micro-batch, so the running totals are an ordered pass over a small table.
    """
    steps = spark.read.schema(STEP).parquet(f"{path}/batch=*")
    until = Window.orderBy("batch_id").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return steps.select(
        "batch_id", "messages", "long_trips", F.sum("messages").over(until).alias("total_messages"),
        F.sum("long_trips").over(until).alias("total_long_trips"))


def last_counters(spark: SparkSession, path: str) -> DataFrame:
    """The totals after the last micro-batch, as ``bounded_counts`` has them for a complete read."""
    return spark.read.schema(STEP).parquet(f"{path}/batch=*").agg(
        F.coalesce(F.sum("messages"), F.lit(0)).alias("total_messages"),
        F.coalesce(F.sum("long_trips"), F.lit(0)).alias("long_trips"))


def count_stream(
    events: DataFrame, path: str, checkpoint: str, column: str = "trip_distance", above: float = 5.0, name: str | None = None,
    every: str | None = None,
) -> StreamingQuery:
    """Start counting a stream's messages; without ``every`` (a trigger interval) up to the input present now."""
    writer = events.writeStream.foreachBatch(keep_counters(path, column, above)).option("checkpointLocation", checkpoint)
    writer = writer.queryName(name) if name else writer
    return (writer.trigger(processingTime=every) if every else writer.trigger(availableNow=True)).start()


def run_until_idle(
    spark: SparkSession, start: Callable[[], StreamingQuery], name: str, idle_seconds: float, clock: Callable[[], float] = time.monotonic
) -> IdleClock:
    """Run the continuous stream that ``start`` starts under ``name`` until ``idle_seconds`` have passed without input.

    It is stopped between two micro-batches, when none runs and no input waits, so whatever was taken in is whole. A stream
    that fails raises here.
    """
    idle = IdleClock(name, clock)
    spark.streams.addListener(idle)
    try:
        query = start()
        try:
            while not query.awaitTermination(0.2):
                status = query.status
                if idle.idle_for() >= idle_seconds and not status["isTriggerActive"] and not status["isDataAvailable"]:
                    break
        finally:
            query.stop()
    finally:
        spark.streams.removeListener(idle)
    return idle


def count_until_idle(
    events: DataFrame, path: str, checkpoint: str, idle_seconds: float = 5.0, column: str = "trip_distance", above: float = 5.0,
    every: str = "1 second", name: str = "bounded-read",
) -> DataFrame:
    """Read a stream until no message has come for ``idle_seconds``; totals as ``last_counters``.

    Messages that arrive while it reads are counted. Started again on the same checkpoint it counts what is new, and the
    totals go on.
    """
    spark = events.sparkSession
    run_until_idle(spark, lambda: count_stream(events, path, checkpoint, column, above, name, every), name, idle_seconds)
    return last_counters(spark, path)
