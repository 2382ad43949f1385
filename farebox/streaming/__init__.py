"""Event-time aggregates over streams and the tables they maintain."""

from farebox.streaming.producer import send_messages, to_messages, write_messages
from farebox.streaming.progress import count_stream, count_until_idle, last_counters, read_counters, run_until_idle
from farebox.streaming.sessions import open_session_counts
from farebox.streaming.sinks import append_windows, upsert_windows
from farebox.streaming.windows import (
    session_counts_stream,
    top_windows,
    tumbling_counts,
    tumbling_sums,
    with_event_time,
)

__all__ = [
    "append_windows", "count_stream", "count_until_idle", "last_counters", "open_session_counts", "read_counters",
    "run_until_idle", "send_messages", "session_counts_stream", "to_messages", "top_windows", "tumbling_counts",
    "tumbling_sums", "upsert_windows", "with_event_time", "write_messages",
]
