"""Projections, filters and predicates."""

from pyspark.sql import functions as F

from farebox.functions import between_closed, in_half_open, in_month, in_range_of_days, json_fields, on_day
from farebox.operators.conform import drop_zone, ingest_shape, keep_existing, nullable_integer
from farebox.plans import analytics
from workloads import feeds
from workloads.feeds import TRIPS_SQL, TRIP_SQL, ZONES_SQL
from workloads.registry import register

_TRIPS = f"with {TRIPS_SQL}, {TRIP_SQL}"


@register("p4_renamed_to_snake_case", f"""with {TRIPS_SQL}
    select vendorid as vendor_id, pickup as pickup_datetime, dropoff as dropoff_datetime, passengers as passenger_count,
      distance as trip_distance, pu as pu_location_id, "do" as do_location_id, payment as payment_type,
      fare as fare_amount, tip as tip_amount, total as total_amount, 'yellow' as taxi_type,
      timestamp '2025-01-01 00:00:00' as extracted_at
    from feed where service = 'yellow'""")
def p4(spark, sf):
    return ingest_shape(feeds.yellow_raw(spark, sf), "yellow", F.lit("2025-01-01 00:00:00").cast("timestamp"))


@register("p5_keep_existing_columns", "select o_orderkey, o_orderdate, o_totalprice from orders")
def p5(spark, sf):
    return keep_existing(feeds.table(spark, sf, "orders"), ["o_orderkey", "O_ORDERDATE", "airport_fee", "o_totalprice"]).toDF(
        "o_orderkey", "o_orderdate", "o_totalprice")


@register("p6_wall_clock_times", "select event_id, ts from events")
def p6(spark, sf):
    zoned = feeds.table(spark, sf, "events").select("event_id", F.col("ts").cast("timestamp").alias("ts"))
    return drop_zone(zoned)


@register("p7_nullable_integers", f"with {TRIPS_SQL} select try_cast(ratecode as int) as rate_code, count(*) as n from feed group by 1")
def p7(spark, sf):
    return feeds.feed(spark, sf, ["ratecode"]).groupBy(nullable_integer("ratecode").alias("rate_code")).agg(
        F.count(F.lit(1)).alias("n"))


@register("p9_vendor_present", f"with {TRIPS_SQL} select vendorid, distance, fare from feed where vendorid is not null")
def p9(spark, sf):
    return feeds.feed(spark, sf, ["vendorid", "distance", "fare"]).where(F.col("vendorid").isNotNull())


@register("p10_half_open_range", """
    select o_orderkey, o_orderdate from orders where o_orderdate >= '1996-02-01' and o_orderdate < '1996-03-01'""")
def p10(spark, sf):
    return feeds.table(spark, sf, "orders").where(in_half_open("o_orderdate", "1996-02-01", "1996-03-01")).select(
        "o_orderkey", "o_orderdate")


@register("p11_between_midnights", """
    select event_id, ts from events where ts between timestamp '2024-01-05' and timestamp '2024-01-09'""")
def p11(spark, sf):
    return feeds.table(spark, sf, "events").where(between_closed("ts", "2024-01-05", "2024-01-09")).select("event_id", "ts")


@register("p11_between_whole_days", """
    select event_id, ts from events where cast(ts as date) between date '2024-01-05' and date '2024-01-09'""")
def p11_days(spark, sf):
    return feeds.table(spark, sf, "events").where(in_range_of_days("ts", "2024-01-05", "2024-01-09")).select("event_id", "ts")


@register("p12_calendar_day", "select event_id, ts from events where cast(ts as date) = date '2024-01-15'")
def p12(spark, sf):
    return feeds.table(spark, sf, "events").where(on_day("ts", "2024-01-15")).select("event_id", "ts")


@register("p13_month_text", "select o_orderkey, o_orderdate from orders where strftime(o_orderdate, '%m-%Y') = '11-1998'")
def p13(spark, sf):
    return feeds.table(spark, sf, "orders").where(in_month("o_orderdate", "11-1998")).select("o_orderkey", "o_orderdate")


@register("p14_numeric_comparisons", f"""{_TRIPS}
    select count(*) filter (where trip_distance <= 1) as short, count(*) filter (where trip_distance < 40) as plausible,
      count(*) filter (where tip_amount = 0) as no_tip, count(*) filter (where total_amount >= 0) as not_negative,
      count(*) filter (where trip_distance > 5.0) as long from trip""")
def p14(spark, sf):
    distance = F.col("trip_distance")
    return feeds.trips(spark, sf, "trip_distance", "tip_amount", "total_amount").agg(
        F.count_if(distance <= 1).alias("short"), F.count_if(distance < 40).alias("plausible"),
        F.count_if(F.col("tip_amount") == 0).alias("no_tip"), F.count_if(F.col("total_amount") >= 0).alias("not_negative"),
        F.count_if(distance > 5.0).alias("long"))


@register("p15_missing_as_zero", "select event_id from events where coalesce(nullif(value, 7.5), 0) > 5.0")
def p15(spark, sf):
    events = feeds.table(spark, sf, "events").withColumn("distance", F.expr("nullif(value, 7.5)"))
    return events.where(F.coalesce("distance", F.lit(0.0)) > 5.0).select("event_id")


@register("p16_file_name_contains", "select count(*) as row_count from events where strftime(ts, '%Y-%m-%d') like '%2024-01-1%'")
def p16(spark, sf):
    named = feeds.table(spark, sf, "events").withColumn("filename", F.date_format("ts", "yyyy-MM-dd"))
    return analytics.rows_from_files(named, "2024-01-1")


@register("p17_filter_on_dimension", f"""with {TRIPS_SQL}, {TRIP_SQL}, {ZONES_SQL}
    select location_id, fare_amount::double as fare_amount from trip join zones on pickup_location_id = location_id
    where zone = 'NATION_1'""")
def p17(spark, sf):
    zones = feeds.zones(spark, sf).where(F.col("zone") == "NATION_1")
    return feeds.trips(spark, sf, "pickup_location_id", "fare_amount").join(
        zones, F.col("pickup_location_id") == F.col("location_id")).select("location_id", "fare_amount")


_PROPS = """case when event_type = 'click' then '{"k": null}' when event_type = 'view' then '{"other": 1}' else props end"""


@register("p18_json_fields_with_default", """
    select event_id, case when event_type = 'click' then null when event_type = 'view' then 'N/A'
      else json_extract_string(props, '$.k') end as k from events""")
def p18(spark, sf):
    events = feeds.table(spark, sf, "events").withColumn("document", F.expr(_PROPS))
    return events.select("event_id", *json_fields("document", ["k"]))


@register("p19_one_column", "select l_suppkey from lineitem")
def p19_one(spark, sf):
    return feeds.table(spark, sf, "lineitem").select("l_suppkey")


@register("p19_two_columns", "select l_suppkey, l_partkey from lineitem")
def p19_two(spark, sf):
    return feeds.table(spark, sf, "lineitem").select("l_suppkey", "l_partkey")
