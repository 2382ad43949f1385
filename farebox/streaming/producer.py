"""Turn trip rows into messages."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from farebox.functions.fields import message_text
from farebox.functions.times import EVENT_TIME_FORMAT
from farebox.schemas import EVENT_COLUMNS


def _clean(df: DataFrame, name: str) -> Column:
    """Times as text to the second, no passenger count as 0, NaN as NULL."""
    kind = df.schema[name].dataType.typeName()
    col = F.col(name)
    if kind in ("timestamp", "timestamp_ntz"):
        return F.date_format(col, EVENT_TIME_FORMAT).alias(name)
    if kind in ("double", "float"):
        col = F.nanvl(col, F.lit(None).cast(kind))
    if name == "passenger_count":
        col = F.coalesce(col, F.lit(0).cast(df.schema[name].dataType))
    return col.alias(name)


def to_messages(trips: DataFrame, columns: list[str] = EVENT_COLUMNS) -> DataFrame:
    """One JSON text per trip in column ``value``, the shape a topic sink expects."""
    return trips.select(message_text(*[_clean(trips, c) for c in columns]).alias("value"))


def write_messages(trips: DataFrame, path: str, columns: list[str] = EVENT_COLUMNS) -> None:
    """Messages as text files, one object per line, in the order of the input's files."""
    to_messages(trips, columns).write.mode("append").text(path)


def send_messages(trips: DataFrame, servers: str, topic: str, columns: list[str] = EVENT_COLUMNS) -> None:
    """Messages to a topic; needs the Kafka connector package on the session's class path."""
    to_messages(trips, columns).write.format("kafka").options(
        **{"kafka.bootstrap.servers": servers, "topic": topic}
    ).save()
