"""Sorts, limits, top-k (O1-O6) and set operations (U2-U4; U1 is with the models)."""

from pyspark.sql import Window
from pyspark.sql import functions as F

from farebox.operators.aggregates import ranked
from farebox.operators.layout import day_partitioned
from farebox.operators.sessions import session_counts
from farebox.plans import analytics
from farebox.session import scratch_path
from farebox.streaming import top_windows, tumbling_counts
from workloads import feeds
from workloads.feeds import EVENTS_SQL, TRIPS_SQL, TRIP_SQL, ZONES_SQL
from workloads.registry import cents, register
from workloads.windows import session_sql

_WITH = f"with {TRIPS_SQL}, {TRIP_SQL}, {ZONES_SQL}"


@register("o1_best_zone", f"""{_WITH}
    select zone, {cents('sum(total_amount)')} as total_amount from trip join zones on pickup_location_id = location_id
    group by zone order by sum(total_amount) desc, zone limit 1""")
def o1(spark, sf):
    per_location = feeds.trips(spark, sf, "pickup_location_id", "total_amount").groupBy("pickup_location_id").agg(
        F.sum("total_amount").alias("amount"))
    per_zone = per_location.join(feeds.zones(spark, sf), F.col("pickup_location_id") == F.col("location_id")).groupBy(
        "zone").agg(F.sum("amount").alias("total_amount"))
    return ranked(per_zone, [F.col("total_amount").desc(), F.col("zone")], 1)


@register("o2_top_days_under_cut", f"""{_WITH}
    select cast(pickup_datetime as date) as pickup_date, max(trip_distance) as max_trip_distance from trip
    where trip_distance < 49 group by 1 order by 2 desc, 1 limit 5""")
def o2(spark, sf):
    return analytics.longest_trip_days(feeds.trips(spark, sf, "pickup_datetime", "trip_distance"), below=49.0)


def tumbling_sql(key: str, minutes: int) -> str:
    return f"""select time_bucket(interval {minutes} minute, event_timestamp) as window_start,
      time_bucket(interval {minutes} minute, event_timestamp) + interval {minutes} minute as window_end, {key},
      count(*) as num_trips from trip_events group by all"""


@register("o3_top_windows", f"""with {EVENTS_SQL}
    select * from ({tumbling_sql('location', 5)}) order by num_trips desc, window_start, window_end, location limit 5""")
def o3(spark, sf):
    return top_windows(tumbling_counts(feeds.trip_events(spark, sf), "location"), "num_trips")


@register("o4_full_ordered_list", f"{_WITH} select pickup_location_id, {cents('sum(tip_amount)')} as tips from trip group by 1")
def o4(spark, sf):
    sums = feeds.trips(spark, sf, "pickup_location_id", "tip_amount").groupBy("pickup_location_id").agg(
        F.sum("tip_amount").alias("tips"))
    return ranked(sums, [F.col("tips").desc(), F.col("pickup_location_id")])


@register("o5_least_frequent", "select o_custkey, count(*) as trips from orders group by 1 order by trips, o_custkey limit 1")
def o5(spark, sf):
    counts = feeds.table(spark, sf, "orders").groupBy("o_custkey").agg(F.count(F.lit(1)).alias("trips"))
    return ranked(counts, [F.col("trips"), F.col("o_custkey")], 1)


@register("o6_clustered_files", "select event_id, event_type, cast(ts as date) as day from events")
def o6(spark, sf):
    path = scratch_path(spark, "o6")
    day_partitioned(feeds.table(spark, sf, "events").select("event_id", "event_type", "ts"), "ts", "event_type").parquet(path)
    return spark.read.parquet(path).drop("ts")


@register("o6_order_within_files", "select count(*) as events, 0::bigint as out_of_order from events")
def o6_order(spark, sf):
    path = scratch_path(spark, "o6o")
    day_partitioned(feeds.table(spark, sf, "events").select("event_id", "event_type", "ts"), "ts", "event_type").parquet(path)
    rows = spark.read.parquet(path).select("event_type", F.col("_metadata.file_path").alias("file"), F.col("_metadata.row_index").alias("place"))
    before = F.lag("event_type").over(Window.partitionBy("file").orderBy("place"))
    return rows.withColumn("before", before).agg(
        F.count(F.lit(1)).alias("events"), F.count_if(F.col("before") > F.col("event_type")).alias("out_of_order"))


@register("u2_union_of_differing_columns", """
    select c_custkey as id, c_acctbal as amount, c_mktsegment as segment from customer
    union all select s_suppkey, s_acctbal, null from supplier""")
def u2(spark, sf):
    customers = feeds.table(spark, sf, "customer").select(
        F.col("c_custkey").alias("id"), F.col("c_acctbal").alias("amount"), F.col("c_mktsegment").alias("segment"))
    suppliers = feeds.table(spark, sf, "supplier").select(F.col("s_acctbal").alias("amount"), F.col("s_suppkey").alias("id"))
    return customers.unionByName(suppliers, allowMissingColumns=True)


@register("u3_distinct_pairs", "select distinct l_returnflag, l_linestatus from lineitem")
def u3(spark, sf):
    return feeds.table(spark, sf, "lineitem").select("l_returnflag", "l_linestatus").distinct()


@register("u4_distinct_in_range", """
    select distinct l_linenumber as vendor_id from lineitem
    where l_shipdate between timestamp '1997-03-01' and timestamp '1997-03-15'""")
def u4(spark, sf):
    lines = feeds.table(spark, sf, "lineitem").select(
        F.col("l_linenumber").alias("vendor_id"), F.col("l_shipdate").alias("dropoff_datetime"))
    return analytics.vendors_between(lines, "1997-03-01", "1997-03-15")


@register("o3_top_sessions", f"""select * from ({session_sql('location', 5)})
    order by num_trips desc, window_start, window_end, location limit 5""")
def o3_sessions(spark, sf):
    return top_windows(session_counts(feeds.trip_events(spark, sf), "location", "event_timestamp", 300), "num_trips")
