"""Aggregations (A1-A20; A8 and A19 are with the models)."""

from pyspark.sql import functions as F

from farebox.functions import day_of, hours_between, tip_bucket, tip_bucket_rank
from farebox.operators.aggregates import load_report, money
from farebox.operators.checks import duplicate_count
from farebox.plans import analytics
from farebox.plans.interval import trips_report
from farebox.sources import bounded_counts
from workloads import feeds
from workloads.feeds import INGESTED_SQL, PAYMENTS_SQL, TRIPS_SQL, TRIP_SQL, ZONES_SQL
from workloads.registry import cents, register

_TRIPS = f"with {TRIPS_SQL}, {TRIP_SQL}"


@register("a1_count_all", "select count(*) as row_count from lineitem")
def a1(spark, sf):
    return feeds.table(spark, sf, "lineitem").agg(F.count(F.lit(1)).alias("row_count"))


@register("a2_filtered_count", "select count(*) as trips from orders where o_orderdate >= '1997-01-01' and o_totalprice <= 100000")
def a2(spark, sf):
    return feeds.table(spark, sf, "orders").where(
        (F.col("o_orderdate") >= F.lit("1997-01-01").cast("timestamp_ntz")) & (F.col("o_totalprice") <= 100000)
    ).agg(F.count(F.lit(1)).alias("trips"))


@register("a3_count_present_values", f"{_TRIPS} select count(payment_type) as with_code, count(vendor_id) as with_vendor from trip where tip_amount = 0")
def a3(spark, sf):
    return feeds.trips(spark, sf, "payment_type", "vendor_id", "tip_amount").where(F.col("tip_amount") == 0).agg(
        F.count("payment_type").alias("with_code"), F.count("vendor_id").alias("with_vendor"))


@register("a4_count_distinct", "select count(distinct l_suppkey) as suppliers, count(distinct l_partkey) as parts from lineitem")
def a4(spark, sf):
    return feeds.table(spark, sf, "lineitem").agg(
        F.count_distinct("l_suppkey").alias("suppliers"), F.count_distinct("l_partkey").alias("parts"))


@register("a5_distinct_of_one_count", "select distinct count(*) as row_count from orders where o_orderpriority like '%URGENT%'")
def a5(spark, sf):
    return feeds.table(spark, sf, "orders").where(F.col("o_orderpriority").contains("URGENT")).agg(
        F.count(F.lit(1)).alias("row_count"))


@register("a6_max_per_day", "select cast(o_orderdate as date) as pickup_date, max(o_totalprice) as max_price from orders group by pickup_date")
def a6(spark, sf):
    return feeds.table(spark, sf, "orders").groupBy(day_of("o_orderdate").alias("pickup_date")).agg(
        F.max("o_totalprice").alias("max_price"))


@register("a7_sum_per_location", f"{_TRIPS} select pickup_location_id, {cents('sum(total_amount)')} as total_amount from trip group by 1")
def a7(spark, sf):
    return feeds.trips(spark, sf, "pickup_location_id", "total_amount").groupBy("pickup_location_id").agg(
        F.sum("total_amount").alias("total_amount"))


@register("a9_daily_report", f"""with {TRIPS_SQL}, {INGESTED_SQL}, {PAYMENTS_SQL}
    select taxi_type, cast(pickup_datetime as date) as pickup_date, coalesce(description, 'unknown') as payment_type_name,
      count(*) as total_trips, cast(sum(passenger_count) as bigint) as total_passengers,
      round(avg(trip_distance), 6) as avg_trip_distance, {cents('sum(cast(fare_amount as decimal(18,2)))')} as total_fare,
      {cents('sum(cast(tip_amount as decimal(18,2)))')} as total_tips, {cents('sum(cast(total_amount as decimal(18,2)))')} as total_revenue
    from ingested left join payments using (payment_type)
    where pickup_datetime >= '1996-01-01' and pickup_datetime < '1997-01-01' group by 1, 2, 3""")
def a9(spark, sf):
    amounts = {c: F.col(c).cast("decimal(18,2)") for c in ("fare_amount", "tip_amount", "total_amount")}
    lookup = feeds.payment_lookup(spark)
    rows = feeds.ingested(spark, sf).withColumns(amounts).join(
        lookup, F.col("payment_type") == F.col("payment_type_id"), "left")
    report = trips_report(rows, "1996-01-01", "1997-01-01")
    return report.withColumn("avg_trip_distance", F.round("avg_trip_distance", 6))


@register("a10_time_range", "select min(ts) as earliest, max(ts) as latest from events")
def a10(spark, sf):
    return analytics.date_range(feeds.table(spark, sf, "events"), "ts")


_TIPS = "with paged as (select cast(value as decimal(18,2)) as tip_amt, event_type as payment_type, ts from events)"


@register("a11_rounded_bundle", f"""{_TIPS} select {cents('sum(tip_amt)')} as total_tips, round(avg(tip_amt), 2) as avg_tip,
    {cents('max(tip_amt)')} as max_tip, count(*) filter (where tip_amt > 0) as tippers from paged""")
def a11(spark, sf):
    return analytics.tip_summary(feeds.paged_trips(spark, sf), "tip_amt")


@register("a12_max_of_expression", """
    select max((epoch(l_shipdate) - epoch(o_orderdate)) / 3600) as max_hours
    from lineitem join orders on l_orderkey = o_orderkey""")
def a12(spark, sf):
    return feeds.trips(spark, sf, "pickup_datetime", "dropoff_datetime").agg(
        F.max(hours_between("pickup_datetime", "dropoff_datetime")).alias("max_hours"))


@register("a13_least_frequent_zone", f"""with {TRIPS_SQL}, {TRIP_SQL}, {ZONES_SQL}
    select zone, count(pickup_location_id) as trip_count from trip join zones on pickup_location_id = location_id
    group by zone order by trip_count, zone limit 1""")
def a13(spark, sf):
    return analytics.least_frequent_zone(feeds.trips(spark, sf, "pickup_location_id"), feeds.zones(spark, sf))


_BUCKET = """case when {0} = 0 then {1} when {0} < 2 then {2} when {0} < 5 then {3} when {0} < 10 then {4}
    when {0} < 20 then {5} else {6} end"""
BUCKET_SQL = _BUCKET.format("tip_amt", "'0'", "'0–2'", "'2–5'", "'5–10'", "'10–20'", "'20+'")
RANK_SQL = _BUCKET.format("tip_amt", 0, 1, 2, 3, 4, 5)


@register("a14_tip_classes", f"{_TIPS} select {BUCKET_SQL} as bucket, {RANK_SQL} as sort_order, {cents('sum(tip_amt)')} as tips from paged group by 1, 2")
def a14(spark, sf):
    return feeds.paged_trips(spark, sf).groupBy(
        tip_bucket("tip_amt").alias("bucket"), tip_bucket_rank("tip_amt").alias("sort_order")
    ).agg(F.sum("tip_amt").alias("tips"))


@register("a15_rounded_mean_per_group", """
    select p_brand as brand, round(cast(sum(cast(p_retailprice as decimal(18,2))) as double) / count(*), 2) as avg_price
    from part group by 1""")
def a15(spark, sf):
    return feeds.table(spark, sf, "part").groupBy(F.col("p_brand").alias("brand")).agg(
        F.round(money("p_retailprice").cast("double") / F.count(F.lit(1)), 2).alias("avg_price"))


@register("a16_long_trips_in_full_pass", f"{_TRIPS} select count(*) as total_messages, count(*) filter (where trip_distance > 5.0) as long_trips from trip")
def a16(spark, sf):
    return bounded_counts(feeds.trips(spark, sf, "trip_distance"))


@register("a17_trips_per_month_text", "select strftime(o_orderdate, '%Y-%m') as month, count(*) as trips from orders group by 1")
def a17_month(spark, sf):
    return analytics.trips_per_period(feeds.table(spark, sf, "orders"), "o_orderdate", "yyyy-MM", "month")


@register("a17_trips_per_day_text", "select strftime(ts, '%Y-%m-%d') as day, count(*) as trips from events group by 1")
def a17_day(spark, sf):
    return analytics.trips_per_period(feeds.table(spark, sf, "events"), "ts", "yyyy-MM-dd", "day")


@register("a18_duplicate_count", "select count(*) - count(distinct l_orderkey) as duplicates from lineitem")
def a18(spark, sf):
    return duplicate_count(feeds.table(spark, sf, "lineitem"), "l_orderkey")


@register("a20_load_report", """
    with units as (select o_orderstatus as kind, cast(date_trunc('month', o_orderdate) as date) as month,
      count(*) as row_count from orders group by 1, 2)
    select *, cast(sum(row_count) over (order by month, kind) as bigint) as running_rows from units""")
def a20(spark, sf):
    orders = feeds.table(spark, sf, "orders").select(
        F.col("o_orderstatus").alias("kind"), F.trunc("o_orderdate", "month").alias("month"))
    return load_report(orders, ["month", "kind"])
