"""Stored tables: merge, interval overwrite, upsert, ledger, and a whole interval run."""

from datetime import date, datetime
from pathlib import Path

import pytest
from conftest import rows
from pyspark.sql import functions as F

from farebox.operators import layout, tables, versions
from farebox.operators.checks import CheckFailed
from farebox.plans import interval


def _events(spark, *items):
    return spark.createDataFrame([(k, datetime.fromisoformat(t) if t else None, v) for k, t, v in items],
                                 "k string, ts timestamp_ntz, v int")


def _published(events, name):
    tables.replace_table(layout.by_day(events, "ts"), name, partition_by=["day"])


def test_merge_inserts_each_unmatched_row(spark):
    target = spark.createDataFrame([("a", 1)], "id string, v int")
    source = spark.createDataFrame([("a", 9), ("b", 2), ("b", 3), (None, 4)], "id string, v int")
    assert rows(tables.insert_only_merge(target, source, "id")) == [("a", 1), ("b", 2), ("b", 3), (None, 4)]
    once = tables.insert_only_merge(target, source, "id", dedup_source=True, order="v")
    assert rows(once) == [("a", 1), ("b", 2), (None, 4)]


def test_merge_into_table_twice_reads_only_the_days_of_the_source(spark, database, tmp_path, plan_of):
    name = f"{database}.trips"
    old = spark.sql("""select 'a' as id, 1 as v, date '2024-01-01' as day union all select 'old', 0, date '2020-01-01'""")
    tables.create_if_missing(spark, name, old.schema, partition_by=["day"])
    tables.append_rows(old, name)
    new = tables.stored(spark.createDataFrame(
        [("a", 2, date(2024, 1, 1)), ("b", 3, date(2024, 1, 2))], old.schema), f"file:{tmp_path}/new")
    for _ in range(2):
        tables.merge_into_table(spark, name, new, "id", within="day")
    assert rows(spark.table(name).select("id", "v")) == [("a", 1), ("b", 3), ("old", 0)]
    plan = plan_of(tables.rows_to_insert(spark.table(name), new, "id", within="day"))
    # the target's folders are pruned by the source's days, and of its columns only the id is read
    assert "PartitionFilters: [(array_contains(" in plan and "ReadSchema: struct<id:string>" in plan


def test_merge_reads_no_day_between_the_source_s_days(spark, database):
    name = f"{database}.trips"
    days = [date(2002, 1, 1), date(2024, 1, 1), date(2024, 1, 2), date(2098, 1, 1), None]
    schema = "id string, v int, day date"
    tables.create_if_missing(spark, name, spark.createDataFrame([], schema).schema, partition_by=["day"])
    tables.append_rows(spark.createDataFrame([(f"t{i}", i, d) for i, d in enumerate(days)], schema), name)
    source = spark.createDataFrame([("t0", 9, days[0]), ("new", 9, days[3]), ("t4", 9, None)], schema)
    fresh = tables.rows_to_insert(spark.table(name), source, "id", within="day")
    assert rows(fresh) == [("new", 9, days[3])]
    read = spark.table(name).where(tables._value_of("day", source))
    assert rows(read.select("id")) == [("t0",), ("t3",), ("t4",)]


def test_interval_overwrite_frame(spark):
    target = _events(spark, ("keep", "2024-01-01 23:59:59", 1), ("gone", "2024-01-02 00:00:00", 2),
                     ("keep", "2024-01-03 00:00:00", 3), ("keep", None, 4))
    new = _events(spark, ("new", "2024-01-02 12:00:00", 9))
    got = tables.interval_overwrite(target, new, "ts", "2024-01-02", "2024-01-03")
    assert sorted(r.v for r in got.collect()) == [1, 3, 4, 9]


def test_interval_overwrite_in_table(spark, database):
    """Edge days keep their other rows, a day without new rows ends empty, rows outside the interval are not taken."""
    name = f"{database}.events"
    _published(_events(
        spark, ("a", "2024-01-01 01:00:00", 1), ("a", "2024-01-01 18:00:00", 2), ("a", "2024-01-02 10:00:00", 3),
        ("a", "2024-01-03 10:00:00", 4), ("a", "2024-01-04 00:00:00", 5), ("a", None, 6)), name)
    new = _events(spark, ("b", "2024-01-01 12:00:00", 10), ("b", "2024-01-03 23:00:00", 11), ("b", "2024-01-09 00:00:00", 99))
    for _ in range(2):
        tables.overwrite_interval_in_table(spark, name, new, "ts", datetime(2024, 1, 1, 12), datetime(2024, 1, 4))
        assert rows(spark.table(name).select("v")) == [(1,), (10,), (11,), (5,), (6,)]
    days = {r[0] for r in spark.sql(f"show partitions {versions.in_force(spark, name).table}").collect()}
    assert "day=2024-01-02" not in days and "day=2024-01-09" not in days


def test_interval_overwrite_with_nothing_new(spark, database):
    name = f"{database}.events"
    _published(_events(spark, ("a", "2024-01-01 10:00:00", 1), ("a", "2024-01-05 10:00:00", 2)), name)
    none = _events(spark, ("b", "2023-01-01 10:00:00", 9))
    tables.overwrite_interval_in_table(spark, name, none, "ts", datetime(2024, 1, 1), datetime(2024, 1, 3))
    assert rows(spark.table(name).select("v")) == [(2,)]


def test_upsert(spark, database):
    target = spark.createDataFrame([("k1", 1), ("k2", 2)], "k string, v int")
    batch = spark.createDataFrame([("k2", 5, 1), ("k2", 6, 2), ("k3", 7, 1)], "k string, v int, at int")
    assert rows(tables.upsert_by_key(target, batch, ["k"], order="at")) == [("k1", 1), ("k2", 6), ("k3", 7)]
    nulls = spark.createDataFrame([(None, 1), ("a", 2)], "k string, v int")
    assert rows(tables.upsert_by_key(nulls, spark.createDataFrame([(None, 9)], "k string, v int"), ["k"])) == [("a", 2), (None, 9)]
    name = f"{database}.windows"
    stored = spark.sql("select 1 as k, 1 as v, date '2024-01-01' as day union all select 2, 2, date '2024-01-02'")
    tables.replace_table(stored, name, partition_by=["day"])
    change = spark.sql("select 1 as k, 9 as v, date '2024-01-01' as day union all select 3, 3, date '2024-01-03'")
    for _ in range(2):
        tables.upsert_into_table(spark, name, change, ["k"])
    assert rows(spark.table(name).select("k", "v")) == [(1, 9), (2, 2), (3, 3)]


def test_replace_create_append(spark, database):
    name = f"{database}.t"
    df = spark.createDataFrame([(1, "x")], "a int, b string")
    tables.create_if_missing(spark, name, df.schema)
    assert spark.table(name).count() == 0
    tables.append_rows(df.select("b", "a"), name)
    tables.create_if_missing(spark, name, df.schema)
    assert rows(spark.table(name)) == [(1, "x")]
    tables.replace_table(df.limit(0), name)
    assert spark.table(name).count() == 0


@pytest.mark.parametrize("own_path", [True, False])
def test_replacing_a_partitioned_table_leaves_no_old_folder(spark, database, tmp_path, own_path):
    name, path = f"{database}.p", f"file:{tmp_path}/p" if own_path else None
    for day in ("2024-01-01", "2024-01-02"):
        tables.replace_table(spark.sql(f"select 1 as v, date '{day}' as day"), name, path, ["day"])
    assert rows(spark.table(name)) == [(1, date(2024, 1, 2))]



def test_append_writes_a_file_per_folder(spark, database):
    """Rows of all days in all tasks: each day still becomes one file, not one per task."""
    name = f"{database}.by_day"
    source = spark.range(0, 4000, 1, 8).selectExpr("cast(id as string) as id", "date_add(date'2024-01-01', cast(pmod(id, 5) as int)) as day")
    tables.create_if_missing(spark, name, source.schema, partition_by=["day"])
    for _ in range(2):
        tables.merge_into_table(spark, name, source, "id", within="day")
    table = spark.table(name)
    assert table.count() == 4000 and table.select("day").distinct().count() == 5
    assert len(table.inputFiles()) == 5


def test_day_layout_prunes_and_clusters(spark, tmp_path, plan_of):
    events = spark.range(20_000).select(
        (F.col("id") % 7).alias("vendor_id"), F.timestamp_seconds(1_704_067_200 + F.col("id") * 30).cast("timestamp_ntz").alias("ts"))
    path = f"file:{tmp_path}/by_day"
    layout.day_partitioned(events, "ts", "vendor_id").parquet(path)
    pruned = layout.with_day_range(spark.read.parquet(path), "ts", "2024-01-02", "2024-01-04 12:00:00")
    assert pruned.count() == 2 * 2880 + 1440
    plan = plan_of(pruned)
    assert "PartitionFilters: [isnotnull(day" in plan and "PushedFilters: [IsNotNull(ts)" in plan
    one = spark.read.parquet(f"{path}/day=2024-01-02")
    vendors = [r.vendor_id for r in one.collect()]
    assert vendors == sorted(vendors)


def test_a_hot_day_is_written_by_several_tasks(spark, tmp_path):
    """Nearly all rows fall on one day; the rebalance splits that day instead of giving it to one task."""
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "64KB")
    try:
        rows_in = spark.range(0, 300_000, 1, 8).select(
            F.col("id"), F.expr("if(id < 10, timestamp_ntz '2024-01-02', timestamp_ntz '2024-01-01')").alias("ts"))
        path = f"file:{tmp_path}/hot"
        layout.day_partitioned(rows_in, "ts").parquet(path)
        sizes = layout.file_sizes(spark, path).where(F.col("path").contains("2024-01-01")).count()
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    assert sizes > 3
    assert spark.read.parquet(path).count() == 300_000


def test_one_day_output_and_file_sizes(spark, tmp_path):
    path = f"file:{tmp_path}/days"
    for day, n in (("2024-01-01", 2), ("2024-01-02", 3), ("2024-01-01", 5)):
        layout.write_for_day(spark.range(n), path, day)
    assert rows(spark.read.parquet(path).groupBy("day").count()) == [(date(2024, 1, 1), 5), (date(2024, 1, 2), 3)]
    layout.write_in_files(spark.range(1000), 4, f"file:{tmp_path}/four")
    assert layout.mean_file_size(spark, f"file:{tmp_path}/four").first().files == 4


def test_lineage(spark, tmp_path):
    spark.range(3).coalesce(1).write.parquet(f"file:{tmp_path}/src")
    got = tables.with_lineage(spark.read.parquet(f"file:{tmp_path}/src"), taxi_type="green").first()
    assert got.filename.endswith(".parquet") and got.taxi_type == "green" and got.extracted_at is not None


# ---- staging and the interval run ----

def _ingested(spark, *items):
    base = dict(vendor_id=1, pickup_datetime=datetime(2024, 1, 5, 10), dropoff_datetime=datetime(2024, 1, 5, 11), passenger_count=1.0,
                trip_distance=2.0, pu_location_id=1, do_location_id=2, payment_type=1, fare_amount=10.0, tip_amount=1.0,
                total_amount=11.0, taxi_type="yellow", extracted_at=datetime(2025, 1, 1))
    from farebox.schemas import INGESTED_TRIP
    return spark.createDataFrame([tuple({**base, **i}[n] for n in INGESTED_TRIP.names) for i in items], INGESTED_TRIP)


@pytest.fixture
def lookup(spark):
    return spark.createDataFrame([(1, "card"), (2, "cash")], "payment_type_id int, payment_type_name string")


def test_staging_keeps_the_latest_extraction_and_drops_bad_rows(spark, lookup):
    trips = _ingested(
        spark, dict(passenger_count=1.0), dict(passenger_count=2.0, extracted_at=datetime(2025, 2, 1)),
        dict(trip_distance=-1.0, pu_location_id=7), dict(total_amount=-5.0, pu_location_id=8), dict(pickup_datetime=None),
        dict(pickup_datetime=datetime(2024, 2, 1), pu_location_id=9), dict(vendor_id=None, payment_type=6),
        dict(trip_distance=None, pu_location_id=10), dict(trip_distance=float("nan"), pu_location_id=11))
    staged = interval.staging_trips(trips, lookup, "2024-01-01", "2024-02-01")
    assert rows(staged.select("vendor_id", "passenger_count", "payment_type_name")) == [(1, 2.0, "card"), (None, 1.0, None)]
    report = interval.trips_report(staged, "2024-01-01", "2024-02-01")
    assert {(r.payment_type_name, r.total_trips) for r in report.collect()} == {("card", 1), ("unknown", 1)}
    assert {r.passed for r in interval.check_staging(staged).collect()} == {True}


def test_interval_run_is_repeatable(spark, database, tmp_path, lookup):
    """Two months of files, one type missing in the second month; a rerun changes nothing and appends nothing."""
    def month_file(kind, month, items):
        prefix = "tpep" if kind == "yellow" else "lpep"
        df = _ingested(spark, *items).withColumnsRenamed({
            "vendor_id": "VendorID", "pu_location_id": "PULocationID", "do_location_id": "DOLocationID",
            "pickup_datetime": f"{prefix}_pickup_datetime", "dropoff_datetime": f"{prefix}_dropoff_datetime"}).drop("taxi_type", "extracted_at")
        df.write.mode("overwrite").parquet(f"file:{tmp_path}/in/{kind}_{month:%Y-%m}")

    jan, feb = date(2024, 1, 1), date(2024, 2, 1)
    month_file("yellow", jan, [dict(), dict(), dict(pickup_datetime=datetime(2024, 1, 31, 23, 59), payment_type=2),
                               dict(pickup_datetime=datetime(2024, 2, 1), pu_location_id=5)])
    month_file("green", jan, [dict(total_amount=30.0)])
    month_file("yellow", feb, [dict(pickup_datetime=datetime(2024, 2, 3), pu_location_id=6)])
    path_of = lambda kind, month: f"file:{tmp_path}/in/{kind}_{month:%Y-%m}"

    def run(start, end):
        interval.run_interval(spark, database, f"file:{tmp_path}/db", path_of, lookup, start, end)
        return rows(spark.table(f"{database}.trips_report").select("pickup_date", "taxi_type", "payment_type_name", "total_trips"))

    january = [(date(2024, 1, 5), "green", "card", 1), (date(2024, 1, 5), "yellow", "card", 1), (date(2024, 1, 31), "yellow", "cash", 1)]
    assert run(datetime(2024, 1, 1), datetime(2024, 2, 1)) == sorted(january, key=repr)
    ingested = spark.table(f"{database}.ingested_trips").count()
    assert run(datetime(2024, 1, 1), datetime(2024, 2, 1)) == sorted(january, key=repr)
    assert spark.table(f"{database}.ingested_trips").count() == ingested == 5
    both = january + [(date(2024, 2, 1), "yellow", "card", 1), (date(2024, 2, 3), "yellow", "card", 1)]
    assert run(datetime(2024, 2, 1), datetime(2024, 3, 1)) == sorted(both, key=repr)
    ledger = spark.table(f"{database}.load_ledger")
    assert rows(ledger.select("taxi_type", "month", "row_count")) == [("green", jan, 1), ("yellow", jan, 4), ("yellow", feb, 1)]
    assert ledger.where("loaded_at is null").count() == 0


@pytest.mark.parametrize("crash", ["ledger", "publish"])
def test_a_crash_during_ingest_repeats_no_row(spark, database, tmp_path, lookup, monkeypatch, crash):
    """Rows are stored and the ledger is not, or neither: the rerun leaves each file's rows once."""
    def write(month, n):
        rows_in = _ingested(spark, *[dict(pickup_datetime=datetime(2024, month, 1 + i, 10), pu_location_id=i) for i in range(n)])
        rows_in.withColumnsRenamed({"vendor_id": "VendorID", "pu_location_id": "PULocationID", "do_location_id": "DOLocationID",
            "pickup_datetime": "tpep_pickup_datetime", "dropoff_datetime": "tpep_dropoff_datetime"}).drop("taxi_type", "extracted_at").write.mode(
            "overwrite").parquet(f"file:{tmp_path}/in/yellow_{month}")

    write(1, 3)
    write(2, 4)
    path_of = lambda kind, month: f"file:{tmp_path}/in/{kind}_{month.month}"

    def run():
        interval.run_interval(spark, database, f"file:{tmp_path}/db", path_of, lookup, datetime(2024, 1, 1), datetime(2024, 3, 1))

    def dies(*a, **k):
        raise RuntimeError("lost")

    with monkeypatch.context() as m:
        m.setattr(interval, "append_rows" if crash == "ledger" else "publish", dies)
        with pytest.raises(RuntimeError, match="lost"):
            run()
    ingested = spark.table(f"{database}.ingested_trips")
    assert ingested.count() == (7 if crash == "ledger" else 0) and spark.table(f"{database}.load_ledger").count() == 0
    write(2, 2)  # the file was replaced meanwhile: its days that are no longer there go too
    for _ in range(2):
        run()
        assert rows(spark.table(f"{database}.ingested_trips").groupBy("load_month").count()) == [(date(2024, 1, 1), 3), (date(2024, 2, 1), 2)]
    assert rows(spark.table(f"{database}.load_ledger").select("month", "row_count")) == [(date(2024, 1, 1), 3), (date(2024, 2, 1), 2)]
    assert spark.table(f"{database}.staged_trips").count() == 5


def test_rows_that_the_footers_do_not_state_are_refused(spark, database, tmp_path, lookup, monkeypatch):
    path_of = lambda kind, month: f"file:{tmp_path}/in/{kind}"
    raw = _ingested(spark, dict()).withColumnsRenamed({"pickup_datetime": "tpep_pickup_datetime", "dropoff_datetime": "tpep_dropoff_datetime"})
    raw.drop("taxi_type", "extracted_at").write.parquet(f"file:{tmp_path}/in/yellow")
    real = interval.unit_files
    monkeypatch.setattr(interval, "unit_files", lambda *a: ([f._replace(n_rows=f.n_rows + 1) for f in real(*a)[0]], real(*a)[1]))
    with pytest.raises(ValueError, match="footers"):
        interval.run_interval(spark, database, f"file:{tmp_path}/db", path_of, lookup, datetime(2024, 1, 1), datetime(2024, 2, 1))
    assert spark.table(f"{database}.ingested_trips").count() == 0 == spark.table(f"{database}.load_ledger").count()


def test_failed_checks_leave_staged_trips_and_report(spark, database, tmp_path, lookup, monkeypatch):
    """A check that fails is seen before the switch: both tables keep what they had."""
    path_of = lambda kind, month: f"file:{tmp_path}/in/{kind}"
    raw = _ingested(spark, dict(), dict(pu_location_id=5)).withColumnsRenamed({
        "pickup_datetime": "tpep_pickup_datetime", "dropoff_datetime": "tpep_dropoff_datetime"})
    raw.drop("taxi_type", "extracted_at").write.parquet(f"file:{tmp_path}/in/yellow")

    def run():
        interval.run_interval(spark, database, f"file:{tmp_path}/db", path_of, lookup, datetime(2024, 1, 1), datetime(2024, 2, 1))

    run()
    before = rows(spark.table(f"{database}.staged_trips")), rows(spark.table(f"{database}.trips_report"))
    real = interval.staging_trips
    monkeypatch.setattr(interval, "staging_trips", lambda *a: real(*a).unionByName(real(*a)))
    with pytest.raises(CheckFailed, match="no_duplicate_trips"):
        run()
    assert before == (rows(spark.table(f"{database}.staged_trips")), rows(spark.table(f"{database}.trips_report")))


def test_failed_check_stops_the_gate(spark, lookup):
    staged = interval.staging_trips(_ingested(spark, dict()), lookup, "2024-01-01", "2024-02-01")
    from farebox.operators.checks import assert_all
    with pytest.raises(CheckFailed, match="no_duplicate_trips"):
        assert_all(interval.check_staging(staged.union(staged)))


def test_scratch_lies_in_the_configured_folder(spark):
    from farebox.session import scratch_path, shared_dir
    assert shared_dir(spark) == spark.sparkContext.getConf().get("spark.checkpoint.dir")
    assert scratch_path(spark, "x") != scratch_path(spark, "x")


def test_scratch_is_removed_when_asked(spark, monkeypatch):
    from farebox import session
    monkeypatch.setattr(session, "_scratch_paths", [])
    used, unused = session.scratch_path(spark, "x"), session.scratch_path(spark, "y")
    assert tables.stored(spark.range(3), used).count() == 3
    assert session.remove_scratch(spark) == 1 and unused
    assert not Path(used.removeprefix("file:")).exists() and session.remove_scratch(spark) == 0
