"""Sessions of a stream that are in the result table while they are still open.

``session_window`` hands over a session when the watermark has passed it. Here every key's open sessions are state: a
micro-batch puts its events in, hands over each session it changed, with a mark for those that became part of another, and
an event-time timer forgets sessions that no event can reach any more.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from farebox.operators.keyed import GONE
from farebox.streaming.windows import EVENT_TIME

STATE_STORE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


@contextmanager
def rocksdb_state(spark: SparkSession) -> Iterator[None]:
    """Streams started inside keep their state in RocksDB; a stream keeps the store it was started with."""
    setting = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(setting, None)
    spark.conf.set(setting, STATE_STORE)
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(setting)
        else:
            spark.conf.set(setting, before)


def merged(sessions: list[tuple[int, int, int]], times: list[int], gap: int) -> list[tuple[int, int, int]]:
    """Sessions (first, last, events) with more events, all in microseconds; those at most a gap apart are one."""
    spans = sorted([*sessions, *((t, t, 1) for t in times)])
    out: list[tuple[int, int, int]] = []
    for first, last, n in spans:
        if out and first <= out[-1][1] + gap:
            out[-1] = (out[-1][0], max(out[-1][1], last), out[-1][2] + n)
        else:
            out.append((first, last, n))
    return out


class OpenSessions(StatefulProcessor):
    """Per key the sessions that events may still join."""

    def __init__(self, gap_seconds: float, key_type: T.DataType):
        self.gap, self.key_type = int(gap_seconds * 1_000_000), key_type

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.open = handle.getMapState("open", "first long", "last long, events long")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        before = {k[0]: tuple(v) for k, v in self.open.iterator()}
        times = [int(t) for part in rows for t in part["micros"]]
        after = merged([(f, *v) for f, v in before.items()], times, self.gap)
        changed = [(f, last, n, False) for f, last, n in after if before.get(f) != (last, n)]
        firsts = {f for f, _, _ in after}
        lost = [(f, last, n, True) for f, (last, n) in before.items() if f not in firsts]
        for first, *_ in lost:
            self.open.removeKey((first,))
        for first, last, n, _ in changed:
            self.open.updateValue((first,), (last, n))
            # an event exactly a gap later still belongs to the session
            self.handle.registerTimer((last + self.gap) // 1000 + 1)
        yield self._rows(key, changed + lost)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        passed = timerValues.getCurrentWatermarkInMs()
        for first, last in [(k[0], v[0]) for k, v in self.open.iterator()]:
            if (last + self.gap) // 1000 + 1 <= passed:
                self.open.removeKey((first,))
        yield self._rows(key, [])

    def close(self) -> None:
        pass

    def _rows(self, key, sessions: list[tuple]) -> pd.DataFrame:
        return pd.DataFrame({
            "first_at": pd.array([s[0] for s in sessions], "Int64"), "last_at": pd.array([s[1] for s in sessions], "Int64"),
            "key": pd.Series([key[0]] * len(sessions), dtype=object), "num_trips": pd.array([s[2] for s in sessions], "Int64"),
            GONE: pd.array([s[3] for s in sessions], "boolean")})


def open_session_counts(events: DataFrame, key: str, gap_seconds: int = 300, ts: str = EVENT_TIME) -> DataFrame:
    """Trips per session and key on a stream with a watermark, open sessions included: ``window_start``, ``window_end``, the
    key, ``num_trips`` and ``_gone``, true where a session that was handed over has become part of an earlier one.

    For ``update`` mode and a keyed result table. Needs the RocksDB state store (``STATE_STORE``). The state of a key is its
    sessions within the watermark's delay, whatever the number of events.
    """
    key_type = events.schema[key].dataType
    schema = T.StructType([
        T.StructField("first_at", T.LongType()), T.StructField("last_at", T.LongType()), T.StructField("key", key_type),
        T.StructField("num_trips", T.LongType()), T.StructField(GONE, T.BooleanType())])
    rows = events.where(F.col(ts).isNotNull()).select(key, ts, F.unix_micros(F.col(ts).cast("timestamp")).alias("micros"))
    changes = rows.groupBy(key).transformWithStateInPandas(
        statefulProcessor=OpenSessions(gap_seconds, key_type), outputStructType=schema, outputMode="Update", timeMode="EventTime")
    return changes.select(
        F.timestamp_micros("first_at").alias("window_start"),
        F.timestamp_micros(F.col("last_at") + F.lit(int(gap_seconds * 1_000_000))).alias("window_end"),
        F.col("key").alias(key), "num_trips", GONE)
