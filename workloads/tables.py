"""Table writes and incremental maintenance."""

import uuid
from datetime import datetime

from pyspark.sql import functions as F

from farebox.functions import on_day, row_id
from farebox.operators import layout
from farebox.operators import tables as t
from farebox.session import scratch_path
from farebox.streaming import to_messages, tumbling_counts
from workloads import feeds
from workloads.feeds import EVENTS_SQL
from workloads.registry import register
from workloads.sets_and_sorts import tumbling_sql


def fresh_table(spark, name):
    """A table name nobody uses, in a database of its own that lies in the shared folder."""
    database = f"farebox_work_{uuid.uuid4().hex[:12]}"
    spark.sql(f"create database {database} location '{scratch_path(spark, 'work')}'")
    return f"{database}.{name}"


@register("w1_replaced_table", "select * from customer")
def w1(spark, sf):
    name = fresh_table(spark, "w1")
    t.replace_table(feeds.table(spark, sf, "supplier"), name)
    t.replace_table(feeds.table(spark, sf, "customer"), name)
    return spark.table(name)


@register("w2_created_from_header", "select * from supplier")
def w2(spark, sf):
    name = fresh_table(spark, "w2")
    rows = feeds.table(spark, sf, "supplier")
    t.create_if_missing(spark, name, rows.schema)
    t.append_rows(rows, name)
    return spark.table(name)


@register("w3_appended_loads", "select * from orders")
def w3(spark, sf):
    name = fresh_table(spark, "w3")
    orders = feeds.table(spark, sf, "orders")
    t.create_if_missing(spark, name, orders.schema)
    for loaded in (F.col("o_orderstatus") == "F", F.col("o_orderstatus") != "F"):
        t.append_rows(orders.where(loaded), name)
    return spark.table(name)


@register("w4_table_as_select", "select * from orders")
def w4(spark, sf):
    name = fresh_table(spark, "w4")
    feeds.table(spark, sf, "orders").createOrReplaceTempView("w4_source")
    spark.sql(f"create table {name} using parquet as select * from w4_source")
    spark.catalog.dropTempView("w4_source")
    return spark.table(name)


@register("w5_day_partitioned_clustered", "select event_id, ts, event_type, value, cast(ts as date) as day from events")
def w5(spark, sf):
    name = fresh_table(spark, "w5")
    events = feeds.table(spark, sf, "events").select("event_id", "ts", "event_type", "value")
    layout.day_partitioned(events, "ts", "event_type").saveAsTable(name)
    return spark.table(name)


@register("w6_files_of_equal_size", "select l_orderkey, l_linenumber, l_extendedprice, l_shipdate from lineitem")
def w6(spark, sf):
    path = scratch_path(spark, "w6")
    layout.write_in_files(feeds.table(spark, sf, "lineitem"), 4, path)
    return spark.read.parquet(path).select("l_orderkey", "l_linenumber", "l_extendedprice", "l_shipdate")


@register("w6_file_count", "select cast(4 as bigint) as files")
def w6_count(spark, sf):
    path = scratch_path(spark, "w6c")
    layout.write_in_files(feeds.table(spark, sf, "lineitem"), 4, path)
    return layout.mean_file_size(spark, path).select("files")


@register("w7_output_of_one_day", """
    select event_id, case when cast(ts as date) = date '2024-01-08' then -value else value end as value, cast(ts as date) as day
    from events""")
def w7(spark, sf):
    path = scratch_path(spark, "w7")
    events = feeds.table(spark, sf, "events").select("event_id", "value", "ts")
    layout.day_partitioned(events, "ts").parquet(path)
    # the output of one day is made anew (with other values); the other days stay
    one_day = events.where(on_day("ts", "2024-01-08")).withColumn("value", -F.col("value"))
    layout.write_for_day(one_day, path, "2024-01-08")
    return spark.read.parquet(path).drop("ts")


@register("w8_staging_and_copy_in", "select c_custkey, c_name, c_nationkey from customer")
def w8(spark, sf):
    name = fresh_table(spark, "w8")
    rows = feeds.table(spark, sf, "customer").select("c_custkey", "c_name", "c_nationkey")
    csv = scratch_path(spark, "w8-csv")
    rows.write.option("header", True).csv(csv)
    t.create_if_missing(spark, name, rows.schema)
    staged = spark.read.schema(rows.schema).option("header", True).csv(csv)
    t.append_rows(staged, name)
    t.create_if_missing(spark, name, rows.schema)
    return spark.table(name)


_ORDER_ID = "md5(concat_ws('-', cast(o_custkey as varchar), cast(o_orderdate as varchar), o_orderstatus))"


def _orders_with_id(spark, sf):
    return feeds.table(spark, sf, "orders").select(
        row_id("o_custkey", "o_orderdate", "o_orderstatus").alias("unique_row_id"), "o_orderkey", "o_orderdate", "o_orderstatus",
        F.col("o_orderdate").cast("date").alias("day"))


_MERGED = f"""with source as (select {_ORDER_ID} as unique_row_id, o_orderkey, o_orderdate, o_orderstatus, cast(o_orderdate as date) as day from orders),
    target as (select * from source where o_orderstatus = 'F')"""


@register("w9_insert_only_merge", f"""{_MERGED}
    select * from target union all select * from source where unique_row_id not in (select unique_row_id from target)""")
def w9(spark, sf):
    source = _orders_with_id(spark, sf)
    return t.insert_only_merge(source.where("o_orderstatus = 'F'"), source, "unique_row_id", within="day")


@register("w9_insert_only_merge_deduplicated", f"""{_MERGED}
    select * from target union all select * from source where unique_row_id not in (select unique_row_id from target)
    qualify row_number() over (partition by unique_row_id order by o_orderkey) = 1""")
def w9_dedup(spark, sf):
    source = _orders_with_id(spark, sf)
    target = source.where("o_orderstatus = 'F'")
    return t.insert_only_merge(target, source, "unique_row_id", dedup_source=True, order="o_orderkey")


@register("w9_merged_table_after_rerun", f"""{_MERGED}
    select unique_row_id, o_orderkey, day from target union all
    select unique_row_id, o_orderkey, day from source where unique_row_id not in (select unique_row_id from target)""")
def w9_table(spark, sf):
    name = fresh_table(spark, "w9")
    source = _orders_with_id(spark, sf).select("unique_row_id", "o_orderkey", "day", "o_orderstatus")
    source_year = source.withColumn("year", F.trunc("day", "year"))
    t.create_if_missing(spark, name, source_year.schema, partition_by=["year"])
    t.append_rows(source_year.where("o_orderstatus = 'F'"), name)
    for _ in range(2):
        t.merge_into_table(spark, name, source_year, "unique_row_id", within="year")
    return spark.table(name).select("unique_row_id", "o_orderkey", "day")


_W10_START, _W10_END = datetime(2024, 1, 3, 6), datetime(2024, 1, 10)
_W10_NEW = """select event_id, ts, event_type, value + 1 as value from events
    where ts >= '2024-01-03 06:00:00' and ts < '2024-01-10' and event_type <> 'error' and cast(ts as date) <> date '2024-01-05'"""
_W10_SQL = f"""select event_id, ts, event_type, value from events where ts < '2024-01-03 06:00:00' or ts >= '2024-01-10'
    union all {_W10_NEW}"""


def _events_and_new(spark, sf):
    events = feeds.table(spark, sf, "events").select("event_id", "ts", "event_type", "value")
    new = events.where((F.col("event_type") != "error") & (F.col("ts").cast("date") != F.lit("2024-01-05").cast("date"))
                       ).withColumn("value", F.col("value") + 1)
    return events, new


@register("w10_interval_overwrite", _W10_SQL)
def w10(spark, sf):
    events, new = _events_and_new(spark, sf)
    inside = new.where((F.col("ts") >= F.lit(str(_W10_START)).cast("timestamp_ntz"))
                       & (F.col("ts") < F.lit(str(_W10_END)).cast("timestamp_ntz")))
    return t.interval_overwrite(events, inside, "ts", _W10_START, _W10_END)


@register("w10_interval_overwrite_in_table", _W10_SQL)
def w10_table(spark, sf):
    # the new rows have none for January 5th, so that day has to end empty
    name = fresh_table(spark, "w10")
    events, new = _events_and_new(spark, sf)
    t.replace_table(layout.by_day(events, "ts"), name, partition_by=["day"])
    for _ in range(2):
        t.overwrite_interval_in_table(spark, name, new, "ts", _W10_START, _W10_END)
    return spark.table(name).drop("day")


@register("w11_pending_units", """
    select distinct o_orderstatus as taxi_type, cast(date_trunc('month', o_orderdate) as date) as month from orders
    where (o_orderstatus, date_trunc('month', o_orderdate)) not in
      (select (o_orderstatus, date_trunc('month', o_orderdate)) from orders where o_totalprice > 490000)""")
def w11(spark, sf):
    orders = feeds.table(spark, sf, "orders")
    unit = [F.col("o_orderstatus").alias("taxi_type"), F.trunc("o_orderdate", "month").alias("month")]
    ledger = orders.where("o_totalprice > 490000").select(*unit).distinct()
    return t.pending_units(orders.select(*unit).distinct(), ledger, ["taxi_type", "month"])


@register("w12_full_refresh", "select event_type, count(*) as n from events group by 1")
def w12(spark, sf):
    name = fresh_table(spark, "w12")
    events = feeds.table(spark, sf, "events")
    for rows in (events.where("event_type = 'click'"), events):
        t.replace_table(rows.groupBy("event_type").agg(F.count(F.lit(1)).alias("n")), name)
    return spark.table(name)


_W13_SQL = f"""with {EVENTS_SQL}, batch as ({tumbling_sql('location', 60)}),
    target as (select window_start, window_end, location, 0 as num_trips from batch where location <> 'click'
      union all select window_start, window_end, 'gone', 7 from batch where location = 'view')
    select * from batch union all select * from target
      where (window_start, location) not in (select (window_start, location) from batch)"""


def _old_and_new_windows(spark, sf):
    batch = tumbling_counts(feeds.trip_events(spark, sf), "location", "1 hour")
    old = batch.where("location <> 'click'").withColumn("num_trips", F.lit(0).cast("long")).unionByName(
        batch.where("location = 'view'").withColumns({"location": F.lit("gone"), "num_trips": F.lit(7).cast("long")}))
    return old, batch


@register("w13_keyed_upsert", _W13_SQL)
def w13(spark, sf):
    old, batch = _old_and_new_windows(spark, sf)
    return t.upsert_by_key(old, batch, ["window_start", "location"])


@register("w13_keyed_upsert_in_table", _W13_SQL)
def w13_table(spark, sf):
    name = fresh_table(spark, "w13")
    old, batch = (df.withColumn("day", F.col("window_start").cast("date")) for df in _old_and_new_windows(spark, sf))
    t.replace_table(layout.by_day(old, "window_start"), name, partition_by=["day"])
    for _ in range(2):
        t.upsert_into_table(spark, name, batch, ["window_start", "location"])
    return spark.table(name).drop("day")


@register("w14_messages", """
    select to_json({'ts': strftime(ts, '%Y-%m-%d %H:%M:%S'), 'user_id': user_id, 'passenger_count': coalesce(nullif(event_id, 5), 0),
      'trip_distance': nullif(value, 1.0)})::varchar as value from events""")
def w14(spark, sf):
    events = feeds.table(spark, sf, "events").withColumns({
        "passenger_count": F.expr("nullif(event_id, 5)"), "trip_distance": F.expr("nullif(value, 1.0)")})
    return to_messages(events, ["ts", "user_id", "passenger_count", "trip_distance"])


@register("w15_lineage_columns", """
    select o_orderkey, 'orders.parquet' as filename, timestamp '2025-01-01 00:00:00' as extracted_at, 'yellow' as taxi_type from orders""")
def w15(spark, sf):
    stamped = t.with_lineage(feeds.table(spark, sf, "orders"), F.lit("2025-01-01 00:00:00").cast("timestamp"), taxi_type="yellow")
    return stamped.select("o_orderkey", "filename", "extracted_at", "taxi_type")
