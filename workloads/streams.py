"""Streams (T1-T11) and the stream questions (Q14). Streams run to the end of their input before the result is read."""

from pyspark.sql import functions as F
from pyspark.sql import types as T

from farebox.operators.sessions import session_counts
from farebox.session import scratch_path
from farebox.sources import stream_event_files
from farebox.streaming import (
    append_windows,
    count_stream,
    last_counters,
    open_session_counts,
    read_counters,
    session_counts_stream,
    top_windows,
    tumbling_counts,
    tumbling_sums,
    upsert_windows,
    with_event_time,
    write_messages,
)
from farebox.streaming.sessions import rocksdb_state
from farebox.streaming.sinks import create_result_table
from workloads import feeds
from workloads.feeds import EVENTS_SQL
from workloads.registry import cents, register
from workloads.sets_and_sorts import tumbling_sql
from workloads.tables import fresh_table
from workloads.windows import session_sql

_MESSAGE = T.StructType([
    T.StructField("lpep_pickup_datetime", T.StringType()), T.StructField("location", T.StringType()),
    T.StructField("trip_distance", T.DoubleType()), T.StructField("tip_amount", T.DecimalType(18, 2)),
])
# messages carry whole seconds
_SECONDS = EVENTS_SQL.replace("ts as event_timestamp", "date_trunc('second', ts) as event_timestamp")


def _send(spark, sf, path, where="true"):
    """Write the events of a time slice as messages."""
    events = feeds.table(spark, sf, "events").where(where).select(
        F.col("ts").alias("lpep_pickup_datetime"), F.col("event_type").alias("location"),
        F.col("value").alias("trip_distance"), F.col("value").cast("decimal(18,2)").alias("tip_amount"))
    write_messages(events, path, _MESSAGE.names)


def _stream(spark, path):
    return with_event_time(stream_event_files(spark, path, _MESSAGE))


def _sent(spark, sf, name):
    path = scratch_path(spark, name)
    _send(spark, sf, path)
    return path


def _run_upsert(spark, windows, keys, mode, name=None, checkpoint=None):
    """Run a window stream into its result table and return the table's name."""
    if name is None:
        name = fresh_table(spark, "windows")
        create_result_table(spark, name, windows, keys)
    upsert_windows(windows, name, keys, checkpoint or scratch_path(spark, "state"), mode, available_now=True).awaitTermination()
    return name


def _table(spark, name):
    return spark.table(name).drop("day")


@register("t1_event_time_from_text", """
    select strftime(ts, '%Y-%m-%d %H:%M:%S') as lpep_pickup_datetime, event_type as location,
      date_trunc('second', ts) as event_timestamp from events""")
def t1(spark, sf):
    rows = _stream(spark, _sent(spark, sf, "t1")).select("lpep_pickup_datetime", "location", "event_timestamp")
    out = scratch_path(spark, "t1-out")
    append_windows(rows, out, scratch_path(spark, "t1-state"), available_now=True).awaitTermination()
    return spark.read.schema(rows.schema).parquet(out)


_COUNTS = f"with {EVENTS_SQL} {tumbling_sql('location', 5)}"
_COUNTS_SECONDS = f"with {_SECONDS} {tumbling_sql('location', 5)}"


@register("t2_tumbling_counts", _COUNTS)
def t2(spark, sf):
    return tumbling_counts(feeds.trip_events(spark, sf), "location")


@register("t2_tumbling_counts_streamed", _COUNTS_SECONDS)
def t2_stream(spark, sf):
    windows = tumbling_counts(_stream(spark, _sent(spark, sf, "t2")), "location")
    return _table(spark, _run_upsert(spark, windows, ["window_start", "location"], "update"))


@register("t3_session_counts", session_sql("location", 5))
def t3(spark, sf):
    return session_counts(feeds.trip_events(spark, sf), "location", "event_timestamp", 300)


_CLOSED = "window_end <= (select max(date_trunc('second', ts)) - interval 5 second from events)"


@register("t3_session_counts_streamed", f"select * from ({session_sql('location', 5).replace(EVENTS_SQL, _SECONDS)}) where {_CLOSED}")
def t3_stream(spark, sf):
    windows = session_counts_stream(_stream(spark, _sent(spark, sf, "t3")), "location")
    return _table(spark, _run_upsert(spark, windows, ["window_start", "location"], "append"))


def _tips_sql(source: str) -> str:
    return f"""with {source} select time_bucket(interval 1 hour, event_timestamp) as window_start,
      time_bucket(interval 1 hour, event_timestamp) + interval 1 hour as window_end,
      {cents('sum(cast(tip_amount as decimal(18,2)))')} as total_tips from trip_events group by 1, 2"""


@register("t4_hourly_tips", _tips_sql(EVENTS_SQL))
def t4(spark, sf):
    return tumbling_sums(feeds.trip_events(spark, sf), F.col("tip_amount").cast("decimal(18,2)"))


@register("t4_hourly_tips_streamed", f"select * from ({_tips_sql(_SECONDS)}) where {_CLOSED}")
def t4_stream(spark, sf):
    windows = tumbling_sums(_stream(spark, _sent(spark, sf, "t4")), "tip_amount")
    return _table(spark, _run_upsert(spark, windows, ["window_start"], "append"))


@register("t5_window_bounds", f"""with {EVENTS_SQL}
    select distinct time_bucket(interval 5 minute, event_timestamp) as window_start,
      time_bucket(interval 5 minute, event_timestamp) + interval 5 minute as window_end from trip_events""")
def t5(spark, sf):
    return tumbling_counts(feeds.trip_events(spark, sf), "location").select("window_start", "window_end").distinct()


@register("t6_restarted_stream", _COUNTS_SECONDS)
def t6(spark, sf):
    # the second run continues from the first one's checkpoint and must neither lose nor repeat messages
    path, checkpoint, name = scratch_path(spark, "t6"), scratch_path(spark, "t6-state"), None
    for part in ("ts < '2024-01-16 00:00:00'", "ts >= '2024-01-16 00:00:00'"):
        _send(spark, sf, path, part)
        windows = tumbling_counts(_stream(spark, path), "location")
        name = _run_upsert(spark, windows, ["window_start", "location"], "update", name, checkpoint)
    return _table(spark, name)


@register("t7_keyed_result_table", f"select * from ({_COUNTS_SECONDS}) where {_CLOSED}")
def t7(spark, sf):
    windows = tumbling_counts(_stream(spark, _sent(spark, sf, "t7")), "location")
    return _table(spark, _run_upsert(spark, windows, ["window_start", "location"], "append"))


@register("t8_late_rows_dropped", _COUNTS_SECONDS)
def t8(spark, sf):
    # the last message file repeats events of windows closed long before; the watermark keeps them out
    path, checkpoint, name = scratch_path(spark, "t8"), scratch_path(spark, "t8-state"), None
    for part in ("ts < '2024-01-11 00:00:00'", "ts >= '2024-01-11 00:00:00' and ts < '2024-01-21 00:00:00'",
                 "ts >= '2024-01-21 00:00:00'", "ts < '2024-01-05 00:00:00' and event_type = 'error'"):
        _send(spark, sf, path, part)
        windows = tumbling_counts(_stream(spark, path), "location")
        name = _run_upsert(spark, windows, ["window_start", "location"], "update", name, checkpoint)
    return _table(spark, name)


_TOP = "order by num_trips desc, window_start, window_end, location limit 5"


@register("t9_top_windows_of_the_table", f"select * from ({_COUNTS_SECONDS}) {_TOP}")
def t9(spark, sf):
    windows = tumbling_counts(_stream(spark, _sent(spark, sf, "t9")), "location")
    return top_windows(_table(spark, _run_upsert(spark, windows, ["window_start", "location"], "update")), "num_trips")


@register("t10_replay_from_earliest", _COUNTS_SECONDS)
def t10(spark, sf):
    # a new reader (fresh checkpoint) sees all messages again; the keyed table ends the same
    path, name = _sent(spark, sf, "t10"), None
    for _ in range(2):
        windows = tumbling_counts(_stream(spark, path), "location")
        name = _run_upsert(spark, windows, ["window_start", "location"], "update", name)
    return _table(spark, name)


_LONG = "count(*) as total_messages, count(*) filter (where value > 5.0) as long_trips"


def _counted(spark, sf, name):
    """Counters of a stream read in several micro-batches: one per part of the month, the last after a restart."""
    path, out, checkpoint = scratch_path(spark, name), scratch_path(spark, f"{name}-out"), scratch_path(spark, f"{name}-state")
    for part in ("ts < '2024-01-11 00:00:00'", "ts >= '2024-01-11 00:00:00'"):
        _send(spark, sf, path, part)
        count_stream(stream_event_files(spark, path, _MESSAGE, max_files=4), out, checkpoint).awaitTermination()
    return out


@register("t11_bounded_stream_counters", f"select {_LONG} from events")
def t11(spark, sf):
    return last_counters(spark, _counted(spark, sf, "t11"))


@register("t11_running_totals", f"select total_messages, long_trips, total_messages as sum_of_steps, 0::bigint as steps_that_fall from (select {_LONG} from events)")
def t11_running(spark, sf):
    # every step's totals are the last ones' and its own
    steps = read_counters(spark, _counted(spark, sf, "t11r"))
    return steps.agg(
        F.max("total_messages").alias("total_messages"), F.max_by("total_long_trips", "batch_id").alias("long_trips"),
        F.sum("messages").alias("sum_of_steps"), F.count_if(F.col("total_messages") < F.col("messages")).alias("steps_that_fall"))


@register("t3_open_sessions_in_the_table", session_sql("location", 5).replace(EVENTS_SQL, _SECONDS))
def t3_open(spark, sf):
    # the second part comes after a restart; sessions that are open at the end are in the table
    with rocksdb_state(spark):
        path, checkpoint, name = scratch_path(spark, "t3o"), scratch_path(spark, "t3o-state"), None
        for part in ("ts < '2024-01-16 00:00:00'", "ts >= '2024-01-16 00:00:00'"):
            _send(spark, sf, path, part)
            windows = open_session_counts(_stream(spark, path), "location", 300)
            name = _run_upsert(spark, windows, ["window_start", "location"], "update", name, checkpoint)
        return _table(spark, name)


@register("q14_busiest_window", f"select * from ({_COUNTS}) {_TOP.replace('limit 5', 'limit 1')}")
def q14_window(spark, sf):
    return top_windows(tumbling_counts(feeds.trip_events(spark, sf), "location"), "num_trips", 1)


@register("q14_longest_session", f"select * from ({session_sql('location', 5)}) {_TOP.replace('limit 5', 'limit 1')}")
def q14_session(spark, sf):
    return top_windows(session_counts(feeds.trip_events(spark, sf), "location", "event_timestamp", 300), "num_trips", 1)


@register("q14_hour_of_highest_tips", f"select * from ({_tips_sql(EVENTS_SQL)}) order by total_tips desc, window_start limit 1")
def q14_tips(spark, sf):
    tips = tumbling_sums(feeds.trip_events(spark, sf), F.col("tip_amount").cast("decimal(18,2)"))
    return top_windows(tips, "total_tips", 1)
