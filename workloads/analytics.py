"""Named questions (Q1-Q6, Q11-Q13, Q15-Q19; Q7-Q10 are with the models, Q14 with the streams)."""

import uuid
from datetime import datetime

from pyspark.sql import functions as F

from farebox.operators.layout import day_partitioned, mean_file_size, with_day_range, write_in_files
from farebox.operators.similarity import top_k_similar
from farebox.operators.tables import insert_only_merge, stored
from farebox.plans import analytics, interval
from farebox.operators.aggregates import share_of_total
from farebox.session import scratch_path
from farebox.sources import bounded_counts
from farebox.plans.month_files import SERVICES, merge_month_file
from workloads import feeds
from workloads.aggregates import BUCKET_SQL, RANK_SQL
from workloads.feeds import INGESTED_SQL, PAYMENTS_SQL, TRIPS_SQL, TRIP_SQL, ZONES_SQL
from workloads.functions import F2_SQL, _text, flow_row_id
from workloads.registry import cents, register

_WITH = f"with {TRIPS_SQL}, {TRIP_SQL}, {ZONES_SQL}"
_PAGED = "with paged as (select ts as trip_pickup_date_time, cast(value as decimal(18,2)) as tip_amt, event_type as payment_type from events)"


@register("q1_short_trips_of_a_month", f"""{_WITH} select count(*) as short_trips from trip
    where pickup_datetime >= '1997-11-01' and pickup_datetime < '1997-12-01' and trip_distance <= 1""")
def q1(spark, sf):
    return analytics.short_trips(feeds.trips(spark, sf, "pickup_datetime", "trip_distance"), "1997-11-01", "1997-12-01")


@register("q2_longest_trip_days", f"""{_WITH} select cast(pickup_datetime as date) as pickup_date,
    max(trip_distance) as max_trip_distance from trip where trip_distance < 100 group by 1 order by 2 desc, 1 limit 5""")
def q2(spark, sf):
    return analytics.longest_trip_days(feeds.trips(spark, sf, "pickup_datetime", "trip_distance"))


@register("q3_biggest_pickup_zone_of_a_day", f"""{_WITH}
    select zone, {cents('sum(total_amount)')} as total_amount from trip join zones on pickup_location_id = location_id
    where cast(pickup_datetime as date) = date '1997-11-18' group by zone order by sum(total_amount) desc, zone limit 1""")
def q3(spark, sf):
    trips = feeds.trips(spark, sf, "pickup_datetime", "pickup_location_id", "total_amount")
    return analytics.biggest_pickup_zone(trips, feeds.zones(spark, sf), "1997-11-18")


@register("q4_dropoff_of_largest_tip", f"""{_WITH}
    select dz.zone as dropoff_zone, {cents('max(tip_amount)')} as max_tip from trip
    join zones pz on pickup_location_id = pz.location_id join zones dz on dropoff_location_id = dz.location_id
    where pz.zone = 'NATION_7' and strftime(pickup_datetime, '%m-%Y') = '11-1997'
    group by 1 order by max(tip_amount) desc, 1 limit 1""")
def q4(spark, sf):
    trips = feeds.trips(spark, sf, "pickup_datetime", "pickup_location_id", "dropoff_location_id", "tip_amount")
    return analytics.largest_tip_dropoff(trips, feeds.zones(spark, sf), "NATION_7", "11-1997")


@register("q5_rows_by_file_year", "select count(*) as row_count from orders where 'yellow_' || strftime(o_orderdate, '%Y-%m') like '%1996%'")
def q5(spark, sf):
    named = feeds.table(spark, sf, "orders").withColumn(
        "filename", F.concat(F.lit("yellow_"), F.date_format("o_orderdate", "yyyy-MM")))
    return analytics.rows_from_files(named, "1996")


@register("q6_distinct_zones_and_zero_tips", f"""{_WITH}
    select count(distinct pickup_location_id) as pickup_zones,
      (select count(fare_amount) from trip where fare_amount = 0) as zero_fares from trip""")
def q6(spark, sf):
    zones = analytics.distinct_pickup_zones(feeds.trips(spark, sf, "pickup_location_id"))
    zero = analytics.zero_fare_trips(feeds.trips(spark, sf, "fare_amount"))
    return zones.select("pickup_zones", zero.scalar().alias("zero_fares"))


@register("q6_vendors_in_range_plain", """
    select distinct event_type as vendor_id from events where ts between timestamp '2024-01-03' and timestamp '2024-01-15'""")
def q6_plain(spark, sf):
    events = feeds.table(spark, sf, "events").select(F.col("event_type").alias("vendor_id"), F.col("ts").alias("dropoff_datetime"))
    return analytics.vendors_between(events, "2024-01-03", "2024-01-15")


@register("q6_vendors_in_range_partitioned", """
    select distinct event_type as vendor_id from events where ts between timestamp '2024-01-03' and timestamp '2024-01-15'""")
def q6_partitioned(spark, sf):
    path = scratch_path(spark, "q6")
    events = feeds.table(spark, sf, "events").select(F.col("event_type").alias("vendor_id"), F.col("ts").alias("dropoff_datetime"))
    day_partitioned(events, "dropoff_datetime", "vendor_id").parquet(path)
    pruned = with_day_range(spark.read.parquet(path), "dropoff_datetime", "2024-01-03", "2024-01-16")
    return analytics.vendors_between(pruned, "2024-01-03", "2024-01-15")


_INGESTED = f"with {TRIPS_SQL}, {INGESTED_SQL}, {PAYMENTS_SQL}"
_START, _END = "1996-01-01 00:00:00", "1997-01-01 00:00:00"
_STAGED_SQL = f"""{_INGESTED}, valid as (select * from ingested where pickup_datetime >= '{_START}' and pickup_datetime < '{_END}'
      and trip_distance >= 0 and total_amount >= 0),
    latest as (select * from valid qualify row_number() over (partition by vendor_id, pickup_datetime, dropoff_datetime,
      pu_location_id, do_location_id, fare_amount, tip_amount, total_amount, taxi_type
      order by extracted_at desc, passenger_count, trip_distance, payment_type nulls last) = 1),
    staged as (select md5(concat_ws('-', coalesce(cast(vendor_id as varchar), ''), cast(pickup_datetime as varchar),
        cast(dropoff_datetime as varchar), cast(pu_location_id as varchar), cast(do_location_id as varchar),
        {_text('fare_amount')}, {_text('tip_amount')}, {_text('total_amount')}, taxi_type)) as trip_id,
      pickup_datetime, dropoff_datetime, taxi_type, vendor_id, passenger_count, trip_distance,
      pu_location_id as pickup_location_id, do_location_id as dropoff_location_id, payment_type,
      description as payment_type_name, fare_amount, tip_amount, total_amount, extracted_at
      from latest left join payments using (payment_type))"""


@register("q11_staged_trips_of_an_interval", f"{_STAGED_SQL} select * from staged")
def q11(spark, sf):
    return interval.staging_trips(feeds.ingested(spark, sf), feeds.payment_lookup(spark), _START, _END)


_REPORT_SQL = f"""select taxi_type, cast(pickup_datetime as date) as pickup_date, coalesce(payment_type_name, 'unknown') as payment_type_name,
      count(*) as total_trips, cast(sum(passenger_count) as bigint) as total_passengers,
      round(avg(trip_distance), 6) as avg_trip_distance, {cents('sum(cast(fare_amount as decimal(18,2)))')} as total_fare,
      {cents('sum(cast(tip_amount as decimal(18,2)))')} as total_tips, {cents('sum(cast(total_amount as decimal(18,2)))')} as total_revenue
    from staged group by 1, 2, 3"""


@register("q12_daily_report_of_an_interval", f"{_STAGED_SQL} {_REPORT_SQL}")
def q12(spark, sf):
    staged = interval.staging_trips(feeds.ingested(spark, sf), feeds.payment_lookup(spark), _START, _END)
    exact = staged.withColumns({c: F.col(c).cast("decimal(18,2)") for c in ("fare_amount", "tip_amount", "total_amount")})
    report = interval.trips_report(exact, _START, _END)
    return report.withColumn("avg_trip_distance", F.round("avg_trip_distance", 6))


_LOADED_SQL = _STAGED_SQL.replace("distance - 1 as", "distance as").replace(
    "dropoff as extracted_at", "timestamp '2025-01-01' as extracted_at").replace(_END, "1996-03-01 00:00:00")


@register("q12_interval_run", f"{_LOADED_SQL} {_REPORT_SQL}")
def q12_run(spark, sf):
    # month files, ledger, staging, checks and report, all as stored tables
    root = scratch_path(spark, "q12")
    for kind, raw, pickup in (("yellow", feeds.yellow_raw(spark, sf), "tpep_pickup_datetime"),
                              ("green", feeds.green_raw(spark, sf), "lpep_pickup_datetime")):
        (raw.withColumn("month", F.trunc(pickup, "month")).hint("rebalance", F.col("month"))
         .write.partitionBy("month").parquet(f"{root}/in/{kind}"))
    database = f"farebox_run_{uuid.uuid4().hex[:12]}"
    interval.run_interval(
        spark, database, f"{root}/tables", lambda kind, month: f"{root}/in/{kind}/month={month}",
        feeds.payment_lookup(spark), datetime.fromisoformat(_START), datetime(1996, 3, 1))
    report = spark.table(f"{database}.trips_report").drop("day")
    amounts = {c: F.round(c, 2) for c in ("total_fare", "total_tips", "total_revenue")}
    return report.withColumns({
        **amounts, "avg_trip_distance": F.round("avg_trip_distance", 6),
        "total_passengers": F.col("total_passengers").cast("long")})


@register("q13_trips_on_a_day", "select count(*) as trips from events where cast(ts as date) = date '2024-01-15'")
def q13_day(spark, sf):
    return analytics.trips_on_day(feeds.table(spark, sf, "events").withColumnRenamed("ts", "pickup_datetime"), "2024-01-15")


@register("q13_longest_trip_hours", f"{_WITH} select max((epoch(dropoff_datetime) - epoch(pickup_datetime)) / 3600) as max_hours from trip")
def q13_hours(spark, sf):
    return analytics.longest_trip_hours(feeds.trips(spark, sf, "pickup_datetime", "dropoff_datetime"))


@register("q13_least_frequent_zone", f"""{_WITH}
    select zone, count(*) as trip_count from trip join zones on pickup_location_id = location_id group by 1 order by 2, 1 limit 1""")
def q13_zone(spark, sf):
    return analytics.least_frequent_zone(feeds.trips(spark, sf, "pickup_location_id"), feeds.zones(spark, sf))


@register("q13_mean_file_size")
def q13_size(spark, sf):
    path = scratch_path(spark, "q13")
    write_in_files(feeds.table(spark, sf, "lineitem"), 4, path)
    return mean_file_size(spark, path)


@register("q13_file_sizes", "select 4::bigint as files, count(*) as all_rows, true as of_equal_rows, true as mean_is_right from lineitem")
def q13_files(spark, sf):
    path = scratch_path(spark, "q13f")
    write_in_files(feeds.table(spark, sf, "lineitem"), 4, path)
    per_file = spark.read.parquet(path).groupBy(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_size").alias("size")).count()
    mean = mean_file_size(spark, path).select("mean_mb").scalar()
    return per_file.agg(
        F.count(F.lit(1)).alias("files"), F.sum("count").alias("all_rows"),
        (F.max("count") - F.min("count") <= 64).alias("of_equal_rows"),
        (F.abs(F.avg("size") / (1 << 20) - mean) <= 0.006).alias("mean_is_right"))


@register("q15_long_trips", f"{_WITH} select count(*) as total_messages, count(*) filter (where trip_distance > 5) as long_trips from trip")
def q15(spark, sf):
    return bounded_counts(feeds.trips(spark, sf, "trip_distance"))


@register("q16_payment_shares", """
    select event_type as payment_type, count(*) as trips,
      cast(round(count(*) * 100.0 / sum(count(*)) over (), 2) as double) as pct from events group by 1""")
def q16_shares(spark, sf):
    return share_of_total(feeds.paged_trips(spark, sf), "payment_type").orderBy(F.col("trips").desc(), "payment_type")


@register("q16_tip_summary", f"""{_PAGED} select {cents('sum(tip_amt)')} as total_tips, round(avg(tip_amt), 2) as avg_tip,
    {cents('max(tip_amt)')} as max_tip, count(*) filter (where tip_amt > 0) as tippers from paged""")
def q16_tips(spark, sf):
    return analytics.tip_summary(feeds.paged_trips(spark, sf), "tip_amt")


@register("q16_tip_histogram", f"{_PAGED} select {BUCKET_SQL} as bucket, {RANK_SQL} as sort_order, count(*) as trips from paged group by 1, 2")
def q16_histogram(spark, sf):
    return analytics.tip_histogram(feeds.paged_trips(spark, sf), "tip_amt")


@register("q16_trips_per_month", f"{_PAGED} select strftime(trip_pickup_date_time, '%Y-%m') as month, count(*) as trips from paged group by 1")
def q16_months(spark, sf):
    return analytics.trips_per_period(feeds.paged_trips(spark, sf), "trip_pickup_date_time", "yyyy-MM", "month")


@register("q16_trips_per_day", f"{_PAGED} select strftime(trip_pickup_date_time, '%Y-%m-%d') as day, count(*) as trips from paged group by 1")
def q16_days(spark, sf):
    return analytics.trips_per_period(feeds.paged_trips(spark, sf), "trip_pickup_date_time", "yyyy-MM-dd", "day")


@register("q16_date_range", f"{_PAGED} select min(trip_pickup_date_time) as earliest, max(trip_pickup_date_time) as latest from paged")
def q16_range(spark, sf):
    return analytics.date_range(feeds.paged_trips(spark, sf), "trip_pickup_date_time")


@register("q17_mean_price_by_brand", """
    select case when p_type = 'ECONOMY' then 'N/A' else nullif(p_brand, 'Brand#7') end as brand,
      round(avg(p_retailprice), 2) as avg_price from part group by 1""")
def q17(spark, sf):
    # economy parts carry no brand key at all, one brand is an explicit null
    with_brand = F.to_json(
        F.struct(F.expr("nullif(p_brand, 'Brand#7')").alias("brand"), F.col("p_retailprice").alias("price")),
        {"ignoreNullFields": "false"})
    without = F.to_json(F.struct(F.col("p_retailprice").alias("price")))
    products = feeds.table(spark, sf, "part").select(
        F.when(F.col("p_type") == "ECONOMY", without).otherwise(with_brand).alias("product"))
    return analytics.mean_price_by_brand(products, "product")


@register("q18_hash_id_merge", f"""with {TRIPS_SQL}, source as (select {F2_SQL} as unique_row_id, distance, fare, service from feed),
    target as (select * from source where service = 'green')
    select * from target union all select * from source where unique_row_id not in (select unique_row_id from target)""")
def q18(spark, sf):
    columns = ["vendorid", "pickup", "dropoff", "pu", "do", "fare", "distance", "service"]
    hashed = feeds.feed(spark, sf, columns).select(flow_row_id().alias("unique_row_id"), "distance", "fare", "service")
    source = stored(hashed, scratch_path(spark, "q18"))
    return insert_only_merge(source.where("service = 'green'"), source, "unique_row_id")


@register("q18_month_files_merged", f"""with {TRIPS_SQL}
    select {F2_SQL} as unique_row_id, service || '_tripdata.csv' as filename, distance as trip_distance, fare as fare_amount,
      cast(pickup as date) as day from feed""")
def q18_files(spark, sf):
    # gzip CSV files, as they are published, of both services with their declared columns, each merged twice into its own table
    root, run = scratch_path(spark, "q18"), uuid.uuid4().hex[:12]
    spark.sql(f"create database farebox_run_{run} location '{root}/tables'")
    merged = []
    for service, raw in (("green", feeds.green_raw(spark, sf)), ("yellow", feeds.yellow_raw(spark, sf))):
        schema, prefix = SERVICES[service]
        texts = {f"{prefix}_{end}_datetime": F.date_format(f"{prefix}_{end}_datetime", "yyyy-MM-dd HH:mm:ss") for end in ("pickup", "dropoff")}
        given = raw.withColumns({**texts, "RatecodeID": F.lit(None).cast("long"), "congestion_surcharge": F.lit(0.0)})
        given.select(*schema.names).write.option("header", True).csv(f"{root}/{service}", compression="gzip")
        name = f"farebox_run_{run}.{service}_tripdata"
        for _ in range(2):
            merge_month_file(spark, name, service, f"{root}/{service}", f"{service}_tripdata.csv")
        merged.append(spark.table(name).select("unique_row_id", "filename", "trip_distance", "fare_amount", "day"))
    return merged[0].union(merged[1])


_CENTROIDS = """centroids as (select label, list(mean order by position) as embedding from (
    select label, position, avg(v) as mean from (select label, unnest(cast(embedding as double[])) as v,
      generate_subscripts(embedding, 1) as position from embeddings) group by 1, 2) group by 1)"""


@register("q19_nearest_vectors_per_label", f"""with {_CENTROIDS},
    scored as (select cast(c.label as bigint) as query_id, vec_id,
      round(list_inner_product(cast(e.embedding as double[]), c.embedding)
        / sqrt(list_inner_product(c.embedding, c.embedding))
        / sqrt(list_inner_product(cast(e.embedding as double[]), cast(e.embedding as double[]))), 9) as score
      from embeddings e, centroids c),
    placed as (select *, cast(row_number() over (partition by query_id order by score desc, vec_id) as int) as position from scored)
    select query_id, vec_id, round(score, 6) as score, position from placed where position <= 10""")
def q19(spark, sf):
    vectors = feeds.table(spark, sf, "embeddings")
    numbers = vectors.select(F.col("label").alias("query_id"), F.posexplode("embedding").alias("place", "number"))
    means = numbers.groupBy("query_id", "place").agg(F.avg(F.col("number").cast("double")).alias("mean"))
    in_order = F.sort_array(F.collect_list(F.struct("place", "mean")))
    queries = means.groupBy("query_id").agg(in_order.getField("mean").alias("embedding"))
    return top_k_similar(vectors, queries, 10).withColumn("score", F.round("score", 6))
