"""Staging models, unified trips, fact and monthly revenue."""

import uuid

from farebox.plans import marts, staging
from farebox.plans.build import build_marts
from farebox.session import scratch_path
from pyspark.sql import functions as F
from workloads import feeds
from workloads.feeds import FACT_SQL, INT_TRIPS_SQL, MONTHLY_SQL, STAGED_SQL, ZONES_SQL, PAYMENTS_SQL
from workloads.registry import cents, register

_MONEY = "trip_distance fare_amount extra mta_tax tip_amount tolls_amount ehail_fee improvement_surcharge total_amount".split()


def _money(*names: str) -> str:
    return ", ".join(f"{cents(n)} as {n}" for n in names)


_STAGED = (
    "vendor_id, rate_code_id, pickup_location_id, dropoff_location_id, pickup_datetime, dropoff_datetime,"
    " store_and_fwd_flag, passenger_count, payment_type, "
)


@register("p1_stage_green", f"with {STAGED_SQL} select {_STAGED} trip_type, {_money(*_MONEY)} from stg_green")
def p1(spark, sf):
    return staging.stg_green_tripdata(feeds.green_raw(spark, sf))


@register("p2_stage_yellow",
          f"with {STAGED_SQL} select {_STAGED} {_money(*[m for m in _MONEY if m != 'ehail_fee'])} from stg_yellow")
def p2(spark, sf):
    return staging.stg_yellow_tripdata(feeds.yellow_raw(spark, sf))


@register("p3_stage_fhv", """
    select nullif(event_type, 'error') as dispatching_base_num, ts as pickup_datetime, ts as dropoff_datetime,
      cast(user_id as int) as pickup_location_id,
      case when event_type <> 'click' then cast(user_id as int) end as dropoff_location_id,
      cast(null as varchar) as sr_flag, props as affiliated_base_number
    from events where event_type <> 'error'""")
def p3(spark, sf):
    return staging.stg_fhv_tripdata(feeds.fhv_raw(spark, sf))


_UNIONED = f"{_STAGED} trip_type, service_type, {_money(*_MONEY)}"


@register("u1_union_all_services", f"with {STAGED_SQL} select {_UNIONED} from unioned")
def u1(spark, sf):
    return feeds.unioned(spark, sf)


@register("p8_aligned_constants", f"""with {STAGED_SQL}
    select service_type, trip_type, {cents('ehail_fee')} as ehail_fee, count(*) as n
    from unioned group by all""")
def p8(spark, sf):
    return feeds.unioned(spark, sf).groupBy("service_type", "trip_type", "ehail_fee").agg(F.count(F.lit(1)).alias("n"))


_INT = f"trip_id, payment_type_description, {_UNIONED}"


@register("q7_unified_deduplicated_trips", f"with {INT_TRIPS_SQL} select {_INT} from int_trips")
def q7(spark, sf):
    return feeds.int_trips(spark, sf)


_FACT = f"{_INT}, pickup_borough, pickup_zone, dropoff_borough, dropoff_zone, trip_duration_minutes"


@register("q8_fact_trips", f"with {FACT_SQL} select {_FACT} from fact")
def q8(spark, sf):
    return feeds.fact(spark, sf)


_MONTHLY = "pickup_zone, revenue_month, service_type, total_monthly_trips, " + ", ".join(
    [f"{cents(f'revenue_monthly_{p}')} as revenue_monthly_{p}" for p in marts.REVENUE_PARTS]
    + [f"round(cast({c} as double), 6) as {c}" for c in ("avg_monthly_passenger_count", "avg_monthly_trip_distance")]
)


def monthly_rounded(spark, sf):
    averages = ("avg_monthly_passenger_count", "avg_monthly_trip_distance")
    return feeds.monthly(spark, sf).withColumns({c: F.round(F.col(c).cast("double"), 6) for c in averages})


register("a8_monthly_zone_revenue", f"with {MONTHLY_SQL} select {_MONTHLY} from monthly")(monthly_rounded)


@register("q9_best_green_zone", f"""with {MONTHLY_SQL}
    select pickup_zone, {cents('sum(revenue_monthly_total_amount)')} as total_rev from monthly
    where service_type = 'Green' and revenue_month >= date '1997-01-01' and revenue_month < date '1998-01-01'
    group by pickup_zone""")
def q9_best(spark, sf):
    return marts.best_zones(feeds.monthly(spark, sf), "Green", 1997)


@register("a19_trips_from_monthly_table", f"""with {MONTHLY_SQL}
    select cast(sum(total_monthly_trips) as bigint) as total_trips from monthly
    where service_type = 'Green' and revenue_month = date '1997-10-01'""")
def a19(spark, sf):
    return marts.trips_in_month(feeds.monthly(spark, sf), "Green", "1997-10-01")


register("q9_green_trips_of_a_month", f"""with {MONTHLY_SQL}
    select cast(sum(total_monthly_trips) as bigint) as total_trips from monthly
    where service_type = 'Green' and revenue_month = date '1996-02-01'""")(
    lambda spark, sf: marts.trips_in_month(feeds.monthly(spark, sf), "Green", "1996-02-01"))


@register("q10_vendor_dimension", f"""with {INT_TRIPS_SQL}
    select distinct vendor_id, case vendor_id when 1 then 'Creative Mobile Technologies' when 2 then 'VeriFone Inc.'
      when 4 then 'Unknown/Other' end as vendor_name from int_trips""")
def q10_vendors(spark, sf):
    # the dedup keeps one trip per vendor-bearing key, so the vendors of the unified trips are the same set
    return marts.dim_vendors(feeds.unioned(spark, sf))


@register("q10_zone_dimension", f"with {ZONES_SQL} select * from zones")
def q10_zones(spark, sf):
    return feeds.zones(spark, sf)


@register("q10_payment_dimension", f"""with {STAGED_SQL}, {PAYMENTS_SQL}
    select p.payment_type as payment_type_id, description, count(u.payment_type) as trips
    from payments p left join unioned u on u.payment_type = p.payment_type group by all""")
def q10_payments(spark, sf):
    dim = marts.dim_payment_types(feeds.payment_types(spark))
    used = feeds.unioned(spark, sf).groupBy("payment_type").agg(F.count("payment_type").alias("n"))
    return dim.join(used, F.col("payment_type_id") == F.col("payment_type"), "left").select(
        "payment_type_id", "description", F.coalesce("n", F.lit(0)).alias("trips"))


# ---- the whole build, with zones for all trips, as its checks demand ----

_ALL_ZONES = MONTHLY_SQL.replace(" where r_name <> 'MIDDLE EAST'", "")


def _built(spark, sf):
    root, database = scratch_path(spark, "marts"), f"farebox_run_{uuid.uuid4().hex[:12]}"
    zones = feeds.zone_lookup(spark, sf, skipped_region="")
    build_marts(spark, database, root, feeds.green_raw(spark, sf), feeds.yellow_raw(spark, sf), feeds.payment_types(spark), zones)
    return database


@register("q8_star_schema_build", f"with {_ALL_ZONES} select {_MONTHLY} from monthly")
def q8_build(spark, sf):
    averages = ("avg_monthly_passenger_count", "avg_monthly_trip_distance")
    monthly = spark.table(f"{_built(spark, sf)}.fct_monthly_zone_revenue")
    return monthly.withColumns({c: F.round(F.col(c).cast("double"), 6) for c in averages})


@register("k9_star_schema_checks", f"""with {_ALL_ZONES}, sizes(model, "check", "column", total_rows) as (
    select 'payment_type_lookup', c, 'payment_type', count(*) from payments, (values ('unique'), ('not_null')) t(c) group by all union all
    select 'dim_zones', c, 'location_id', count(*) from zones, (values ('unique'), ('not_null')) t(c) group by all union all
    select 'staging', 'not_null', 'pickup_datetime', count(*) from unioned group by service_type union all
    select 'int_trips', c, f, count(*) from int_trips, (values ('not_null', 'trip_id'), ('not_null', 'service_type'),
      ('accepted_values', 'service_type'), ('not_null', 'pickup_datetime'), ('not_null', 'total_amount')) t(c, f) group by all union all
    select 'fct_trips', c, f, count(*) from fact, (values ('not_null', 'trip_id'), ('not_null', 'service_type'),
      ('accepted_values', 'service_type'), ('not_null', 'pickup_datetime'), ('not_null', 'total_amount'),
      ('relationships', 'pickup_location_id'), ('relationships', 'dropoff_location_id')) t(c, f) group by all union all
    select 'fct_monthly_zone_revenue', c, f, count(*) from monthly, (values
      ('unique_combination', 'pickup_zone,revenue_month,service_type'), ('not_null', 'pickup_zone'), ('not_null', 'revenue_month'),
      ('not_null', 'service_type'), ('accepted_values', 'service_type'), ('not_null', 'revenue_monthly_total_amount'),
      ('not_null', 'total_monthly_trips')) t(c, f) group by all)
    select *, 0::bigint as failed_rows, true as passed from sizes""")
def k9_build(spark, sf):
    return spark.table(f"{_built(spark, sf)}.check_results")
