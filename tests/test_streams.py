"""Sessions, windows, late rows, restarts."""

import random
import re
import time
from datetime import datetime, timedelta

import pytest
from conftest import rows
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from pyspark.sql import types as T

from farebox.operators.sessions import session_counts
from farebox.sources import stream_event_files
from farebox.streaming import session_counts_stream, top_windows, tumbling_counts, tumbling_sums, upsert_windows, with_event_time
from farebox.streaming.sinks import create_result_table

BASE = datetime(2024, 1, 1)
MESSAGE = T.StructType([
    T.StructField("lpep_pickup_datetime", T.StringType()), T.StructField("PULocationID", T.IntegerType()),
    T.StructField("tip_amount", T.DoubleType())])


def _timed(spark, items):
    return spark.createDataFrame([(k, BASE + timedelta(microseconds=us)) for k, us in items], "k int, ts timestamp_ntz")


def _expected_sessions(items, gap_us):
    out = []
    for key in {k for k, _ in items}:
        times = sorted(us for k, us in items if k == key)
        first = last = times[0]
        n = 0
        for t in times:
            if t > last + gap_us:
                out.append((first, last + gap_us, key, n))
                first, n = t, 0
            last, n = t, n + 1
        out.append((first, last + gap_us, key, n))
    return sorted(out)


def _as_micros(df):
    def us(ts):
        return (ts - BASE) // timedelta(microseconds=1)
    return sorted((us(r.window_start), us(r.window_end), r.k, r.num_trips) for r in df.withColumns({
        c: F.col(c).cast("timestamp_ntz") for c in ("window_start", "window_end")}).collect())


def test_touching_events_share_a_session(spark):
    gap = 300_000_000
    items = [(1, 0), (1, gap), (1, 2 * gap + 1), (2, 5)]
    assert _as_micros(session_counts(_timed(spark, items), "k", "ts", 300)) == _expected_sessions(items, gap)


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.integers(1, 2), st.integers(0, 40_000_000)), min_size=1, max_size=60))
def test_sessions_equal_brute_force(spark, items):
    assert _as_micros(session_counts(_timed(spark, items), "k", "ts", 2)) == _expected_sessions(items, 2_000_000)


@pytest.mark.parametrize("cells", [1, 2, 7])
def test_sessions_across_stretches_equal_brute_force(spark, cells):
    """Stretches of few cells, so that sessions begin, end and run through their borders."""
    at = random.Random(cells)
    items = [(1 + (at.random() < 0.3), at.randrange(-400, 400) * 500_000) for _ in range(300)] + [(3, 0), (3, 2_000_000), (3, 4_000_001)]
    got = session_counts(_timed(spark, items), "k", "ts", 2, cells_per_chunk=cells)
    assert _as_micros(got) == _expected_sessions(items, 2_000_000)


def test_one_key_is_chained_by_many_tasks(spark, plan_of):
    # a key that is a column: the optimiser takes a literal out of the partitioning
    events = spark.range(1000).select(F.least("id", F.lit(0)).alias("k"), F.timestamp_seconds(F.col("id") * 60).cast("timestamp_ntz").alias("ts"))
    plan = plan_of(session_counts(events, "k", "ts", 60, cells_per_chunk=10))
    assert re.search(r"hashpartitioning\(k#\d+L?, chunk", plan) and re.search(r"hashpartitioning\(k#\d+L?, apart", plan)
    # one chain of steps, nothing is computed for two branches
    assert "Union" not in plan and plan[:plan.index("(1)")].count("Exchange") == 3


def test_batch_sessions_equal_builtin_session_window(spark):
    events = spark.range(3000).select(
        (F.col("id") % 3).cast("int").alias("k"), F.timestamp_seconds(1_704_067_200 + F.pmod(F.xxhash64("id"), F.lit(400_000))).alias("ts"))
    builtin = session_counts_stream(events, "k", "5 minutes", "ts")
    assert rows(session_counts(events, "k", "ts", 300)) == rows(builtin)


def test_hot_key_is_summed_before_its_session_task(spark, plan_of):
    events = spark.range(0, 500_000, 1, 8).select(F.least("id", F.lit(0)).alias("k"), F.timestamp_seconds(1_704_067_200 + F.col("id") % 3600).alias("ts"))
    sessions = session_counts(events, "k", "ts", 300)
    assert [r.num_trips for r in sessions.collect()] == [500_000]
    plan = plan_of(session_counts(events, "k", "ts", 300))
    tree = plan[:plan.index("(1)")]
    assert tree.index("Window") < tree.index("HashAggregate", tree.index("Window"))  # aggregated below the window


def _message(spark, path, events, modified):
    """One message file, with a modification time that orders it among the files."""
    import json
    import os
    path.mkdir(exist_ok=True)
    file = path / f"{modified:03d}.json"
    file.write_text("\n".join(json.dumps({
        "lpep_pickup_datetime": (BASE + timedelta(seconds=s)).strftime("%Y-%m-%d %H:%M:%S"), "PULocationID": k, "tip_amount": tip})
        for k, s, tip in events))
    os.utime(file, (1_700_000_000 + modified * 10,) * 2)


def _run(spark, windows, database, tmp_path, keys, mode):
    name = f"{database}.results"
    create_result_table(spark, name, windows, keys)
    query = upsert_windows(windows, name, keys, f"file:{tmp_path}/state", mode, available_now=True)
    query.awaitTermination()
    return spark.table(name).drop("day"), query


def test_late_row_is_dropped_and_counted(spark, database, tmp_path):
    """One file per batch; the fourth file's second row belongs to a window closed by then."""
    for i, seconds in enumerate([[1, 360], [720], [2, 780], [1800]]):
        _message(spark, tmp_path / "in", [(1, s, 1.0) for s in seconds], i)
    stream = with_event_time(stream_event_files(spark, f"file:{tmp_path}/in", MESSAGE, max_files=1))
    table, query = _run(spark, tumbling_counts(stream, "PULocationID"), database, tmp_path, ["window_start", "PULocationID"], "append")
    got = [((r.window_start - BASE).seconds, r.num_trips) for r in table.withColumn(
        "window_start", F.col("window_start").cast("timestamp_ntz")).collect()]
    assert sorted(got) == [(0, 1), (300, 1), (600, 2)]  # the window of second 1800 is still open
    dropped = sum(op["numRowsDroppedByWatermark"] for p in query.recentProgress for op in p["stateOperators"])
    assert dropped == 1


def test_unreadable_event_time_does_not_stop_the_stream(spark, database, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.json").write_text('{"lpep_pickup_datetime": "soon", "PULocationID": 1}\n{"lpep_pickup_datetime": "2024-01-01 00:00:00", "PULocationID": 1}')
    stream = with_event_time(stream_event_files(spark, f"file:{tmp_path}/in", MESSAGE))
    table, _ = _run(spark, tumbling_counts(stream, "PULocationID"), database, tmp_path, ["window_start", "PULocationID"], "update")
    assert [r.num_trips for r in table.collect()] == [1]


def test_stream_equals_batch_and_restart(spark, database, tmp_path):
    events = [(i % 3, i * 37 % 4000, 0.5) for i in range(300)]
    first, second = sorted(events, key=lambda e: e[1])[:150], sorted(events, key=lambda e: e[1])[150:]
    source = f"file:{tmp_path}/in"
    for i, part in enumerate((first, second)):
        _message(spark, tmp_path / "in", part, i)
        stream = with_event_time(stream_event_files(spark, source, MESSAGE))
        table, _ = _run(spark, tumbling_counts(stream, "PULocationID"), database, tmp_path, ["window_start", "PULocationID"], "update")
    whole = with_event_time(spark.read.schema(MESSAGE).json(source))
    assert rows(table) == rows(tumbling_counts(whole, "PULocationID"))
    assert top_windows(table, "num_trips", 1).count() == 1


def test_hourly_sums_and_closed_sessions(spark, database, tmp_path):
    _message(spark, tmp_path / "in", [(1, 0, 1.5), (1, 300, 2.0), (1, 601, 0.0), (2, 10, 1.0), (2, 7300, 4.0)], 0)
    source = f"file:{tmp_path}/in"
    batch = with_event_time(spark.read.schema(MESSAGE).json(source))
    assert [r.total_tips for r in tumbling_sums(batch, "tip_amount").orderBy("window_start").collect()] == [4.5, 4.0]
    stream = with_event_time(stream_event_files(spark, source, MESSAGE))
    table, _ = _run(spark, session_counts_stream(stream, "PULocationID"), database, tmp_path, ["window_start", "PULocationID"], "append")
    closed = session_counts(batch, "PULocationID", "event_timestamp", 300).where("num_trips > 1 or PULocationID = 1 or window_start < timestamp '2024-01-01 01:00:00'")
    assert rows(table) == rows(closed)


def test_timed_trigger_takes_later_files(spark, database, tmp_path):
    """The ten-second trigger: a file that arrives after the first batch is in the table after a later one."""
    _message(spark, tmp_path / "in", [(1, 0, 1.0), (1, 10, 1.0)], 0)
    windows = tumbling_counts(with_event_time(stream_event_files(spark, f"file:{tmp_path}/in", MESSAGE)), "PULocationID")
    name = f"{database}.timed"
    create_result_table(spark, name, windows, ["window_start", "PULocationID"])
    query = upsert_windows(windows, name, ["window_start", "PULocationID"], f"file:{tmp_path}/state", "update")

    def until(expected):
        for _ in range(120):
            if query.exception() is not None:
                raise query.exception()
            got = sorted(r.num_trips for r in spark.table(name).select("num_trips").collect())
            if got == expected:
                return got
            time.sleep(0.5)
        return got

    try:
        assert until([2]) == [2]
        _message(spark, tmp_path / "in", [(1, 20, 1.0), (2, 30, 1.0)], 1)
        assert until([1, 3]) == [1, 3]
    finally:
        query.stop()


# ---- counters while a stream is read, and its end when idle ----

def test_counters_per_batch_with_running_totals(spark, tmp_path):
    """One row per micro-batch, totals that add up, and a restart that goes on with them."""
    from farebox.streaming import count_stream, last_counters, read_counters
    source, out, state = f"file:{tmp_path}/in", f"file:{tmp_path}/out", f"file:{tmp_path}/state"

    def run():
        count_stream(stream_event_files(spark, source, MESSAGE, max_files=1), out, state, "tip_amount").awaitTermination()

    for i, tips in enumerate([[1.0, 6.0], [7.0, 8.0, 5.0]]):
        _message(spark, tmp_path / "in", [(1, 0, t) for t in tips], i)
    run()
    _message(spark, tmp_path / "in", [(1, 0, 9.0)], 2)
    run()
    steps = [tuple(r)[1:] for r in read_counters(spark, out).orderBy("batch_id").collect()]
    assert steps == [(2, 1, 2, 1), (3, 2, 5, 3), (1, 1, 6, 4)]
    assert tuple(last_counters(spark, out).first()) == (6, 4)


def test_a_repeated_batch_is_counted_once(spark, tmp_path):
    from farebox.streaming.progress import keep_counters, last_counters
    keep = keep_counters(f"file:{tmp_path}/out", "v", 5.0)
    for batch_id, n in ((0, 3), (1, 4), (1, 4)):
        keep(spark.range(n).select((F.col("id") + 4).cast("double").alias("v")), batch_id)
    assert tuple(last_counters(spark, f"file:{tmp_path}/out").first()) == (7, 1 + 2)


def test_a_read_ends_when_nothing_comes(spark, tmp_path):
    """Messages that arrive during the read are counted; then the query ends by itself, no earlier than asked."""
    import threading
    from farebox.sources import bounded_counts
    from farebox.streaming import count_until_idle
    folder, later = tmp_path / "in", tmp_path / "later"
    _message(spark, folder, [(1, 0, 6.0), (1, 10, 1.0)], 0)
    _message(spark, later, [(2, 0, 7.0)] * 3, 1)

    def arrive():
        time.sleep(4)
        (later / "001.json").rename(folder / "001.json")

    thread = threading.Thread(target=arrive)
    thread.start()
    began = time.monotonic()
    got = count_until_idle(
        stream_event_files(spark, f"file:{folder}", MESSAGE), f"file:{tmp_path}/out", f"file:{tmp_path}/state", idle_seconds=5.0,
        column="tip_amount", every="0 seconds", name="idle-test")
    took = time.monotonic() - began
    thread.join()
    whole = bounded_counts(spark.read.schema(MESSAGE).json(f"file:{folder}"), "tip_amount")
    assert tuple(got.first()) == tuple(whole.first()) == (5, 4)
    assert took >= 8 and not [q for q in spark.streams.active if q.name == "idle-test"]


def test_idle_clock():
    from types import SimpleNamespace as N
    from farebox.streaming.progress import IdleClock
    now = [10.0]
    clock = IdleClock("q", lambda: now[0])
    assert clock.idle_for() == 0
    clock.onQueryStarted(N(name="q"))
    now[0] = 13.0
    assert clock.idle_for() == 3
    clock.onQueryProgress(N(progress=N(name="other", numInputRows=5)))
    clock.onQueryProgress(N(progress=N(name="q", numInputRows=0)))
    assert clock.idle_for() == 3
    clock.onQueryProgress(N(progress=N(name="q", numInputRows=1)))
    assert clock.idle_for() == 0


def test_a_failing_stream_raises_where_it_is_waited_for(spark, tmp_path):
    from farebox.streaming import run_until_idle
    _message(spark, tmp_path / "in", [(1, 0, 6.0)], 0)

    def start():
        def fail(batch, batch_id):
            raise RuntimeError("no room")
        return stream_event_files(spark, f"file:{tmp_path}/in", MESSAGE).writeStream.queryName("bad").foreachBatch(fail).option(
            "checkpointLocation", f"file:{tmp_path}/state").start()

    with pytest.raises(Exception, match="no room"):
        run_until_idle(spark, start, "bad", 1.0)


# ---- sessions that are in the table while they are open ----

def test_merged_sessions_equal_brute_force():
    from farebox.streaming.sessions import merged
    at = random.Random(4)
    for _ in range(300):
        gap = at.randrange(1, 6)
        times = [at.randrange(40) for _ in range(at.randrange(1, 25))]
        cut = at.randrange(len(times))
        got = merged(merged([], times[:cut], gap), times[cut:], gap)
        assert [(f, last + gap, 1, n) for f, last, n in got] == _expected_sessions([(1, t) for t in times], gap)


def test_open_sessions_are_in_the_table(spark, database, tmp_path):
    """Batches that extend and join sessions, a late row, and a restart: the table equals the batch result after each run,
    open sessions included, and state that no event can reach is given up."""
    from farebox.operators import keyed
    from farebox.streaming import open_session_counts
    from farebox.streaming.sessions import rocksdb_state
    keys, name = ["window_start", "PULocationID"], f"{database}.sessions"
    source = f"file:{tmp_path}/in"
    # 400 joins what begins at 0 and 700; the third file's first row comes after the watermark has passed it by far
    runs = [[[(1, 0, 1.0), (1, 700, 1.0), (2, 50, 1.0)], [(1, 400, 1.0), (2, 5000, 1.0)]], [[(2, 5200, 1.0), (1, 9000, 1.0)], [(1, 9100, 1.0), (1, 10, 1.0)]]]
    with rocksdb_state(spark):
        spark.conf.set("spark.sql.shuffle.partitions", "2")
        try:
            n, state = 0, None
            for run in runs:
                for events in run:
                    _message(spark, tmp_path / "in", events, n)
                    n += 1
                stream = with_event_time(stream_event_files(spark, source, MESSAGE, max_files=1), lateness="600 seconds")
                windows = open_session_counts(stream, "PULocationID", 400)
                create_result_table(spark, name, windows, keys)
                query = upsert_windows(windows, name, keys, f"file:{tmp_path}/state", "update", available_now=True)
                query.awaitTermination()
                whole = with_event_time(spark.read.schema(MESSAGE).json(source)).where("not (PULocationID = 1 and tip_amount = 1.0 and event_timestamp = timestamp '2024-01-01 00:00:10')")
                expected = rows(session_counts(whole, "PULocationID", "event_timestamp", 400))
                assert rows(spark.table(name).drop("day")) == expected
                state = query.recentProgress[-1]["stateOperators"][0]
            dropped = sum(op["numRowsDroppedByWatermark"] for p in query.recentProgress for op in p["stateOperators"])
            assert dropped == 1 and state["numRowsTotal"] < 12
        finally:
            spark.conf.set("spark.sql.shuffle.partitions", "8")
    keyed.compact(spark, name)
    assert rows(spark.table(name).drop("day")) == expected


def test_a_stream_folds_its_deltas(spark, database, tmp_path):
    """Many micro-batches: deltas are folded in on the way, and the table stays exact over a restart."""
    from farebox.operators import keyed
    source, name, keys = f"file:{tmp_path}/in", f"{database}.folded", ["window_start", "PULocationID"]
    for part in range(2):
        for i in range(6):
            _message(spark, tmp_path / "in", [(k, 60 * (i + 6 * part) + k, 1.0) for k in range(3)], i + 6 * part)
        windows = tumbling_counts(with_event_time(stream_event_files(spark, source, MESSAGE, max_files=1)), "PULocationID")
        create_result_table(spark, name, windows, keys)
        upsert_windows(windows, name, keys, f"file:{tmp_path}/state", "update", available_now=True, compact_after=3).awaitTermination()
        whole = with_event_time(spark.read.schema(MESSAGE).json(source))
        assert rows(spark.table(name).drop("day")) == rows(tumbling_counts(whole, "PULocationID"))
    assert len(keyed.stored_deltas(spark, name)) <= 6
    with pytest.raises(ValueError, match="keyed by"):
        upsert_windows(windows, name, ["PULocationID"], f"file:{tmp_path}/other", "update")
