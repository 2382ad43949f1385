"""Trip events as JSON messages: from files, or from a topic where the connector is installed."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from farebox.schemas import GREEN_EVENT


def parse_events(raw: DataFrame, schema: T.StructType = GREEN_EVENT, column: str = "value") -> DataFrame:
    """Message text to columns; the same for batch and stream."""
    return raw.select(F.from_json(F.col(column).cast("string"), schema).alias("event")).select("event.*")


def read_event_files(spark: SparkSession, path: str, schema: T.StructType = GREEN_EVENT) -> DataFrame:
    """All stored messages, bounded."""
    return spark.read.schema(schema).json(path)


def stream_event_files(
    spark: SparkSession,
    path: str,
    schema: T.StructType = GREEN_EVENT,
    max_files: int | None = None,
    file_format: str = "json",
) -> DataFrame:
    """Message files as an unbounded stream from the earliest file on; ``max_files`` bounds one micro-batch."""
    reader = spark.readStream.schema(schema).format(file_format)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.load(path)


def read_event_topic(
    spark: SparkSession,
    servers: str,
    topic: str,
    schema: T.StructType = GREEN_EVENT,
    streaming: bool = True,
    max_offsets: int | None = None,
) -> DataFrame:
    """Topic from its earliest offset; a bounded read stops at the offsets present when it starts.

    Needs the Kafka connector package on the session's class path.
    """
    reader = (spark.readStream if streaming else spark.read).format("kafka").options(
        **{"kafka.bootstrap.servers": servers, "subscribe": topic, "startingOffsets": "earliest"}
    )
    if streaming and max_offsets:
        reader = reader.option("maxOffsetsPerTrigger", max_offsets)
    return parse_events(reader.load(), schema)


def is_long_trip(column: str = "trip_distance", above: float = 5.0) -> Column:
    """Whether the value exceeds ``above``; an absent value counts as 0, NaN as absent."""
    return F.coalesce(F.nanvl(F.col(column).cast("double"), F.lit(None).cast("double")), F.lit(0.0)) > above


def bounded_counts(events: DataFrame, column: str = "trip_distance", above: float = 5.0) -> DataFrame:
    """Messages seen and messages whose value exceeds ``above``; an absent value counts as 0, NaN as absent."""
    return events.agg(
        F.count(F.lit(1)).alias("total_messages"),
        F.count_if(is_long_trip(column, above)).alias("long_trips"),
    )
