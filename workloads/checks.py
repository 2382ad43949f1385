"""Data-quality checks."""

from pyspark.sql import functions as F

from farebox.operators import checks as k
from farebox.operators.tables import stored
from farebox.plans import marts, staging
from farebox.session import scratch_path
from workloads import feeds
from workloads.feeds import FACT_SQL, INT_TRIPS_SQL, MONTHLY_SQL, STAGED_SQL, TRIPS_SQL, TRIP_SQL, ZONES_SQL
from workloads.registry import register

_TRIPS = f"with {TRIPS_SQL}, {TRIP_SQL}"


def rows_sql(source: str, *checks: tuple[str, str, str]) -> str:
    """SQL text: one result row per (check, column, condition that is bad)."""
    return " union all ".join(
        f"""select '{name}' as "check", '{column}' as "column", count(*) filter (where {bad}) as failed_rows,
        count(*) as total_rows, count(*) filter (where {bad}) = 0 as passed from {source}"""
        for name, column, bad in checks)


def groups_sql(name: str, columns: str, source: str, where: str = "true") -> str:
    return f"""select '{name}' as "check", '{columns.replace(', ', ',')}' as "column", count(*) filter (where n > 1) as failed_rows,
      cast(coalesce(sum(n), 0) as bigint) as total_rows, count(*) filter (where n > 1) = 0 as passed
      from (select {columns}, count(*) as n from {source} where {where} group by all)"""


@register("k1_not_null", f"""{_TRIPS} {rows_sql('trip', ('not_null', 'vendor_id', 'vendor_id is null'),
          ('not_null', 'payment_type', 'payment_type is null'), ('not_null', 'pickup_datetime', 'pickup_datetime is null'))}""")
def k1(spark, sf):
    trips = feeds.trips(spark, sf, "vendor_id", "payment_type", "pickup_datetime")
    return k.run_checks(trips, [k.not_null(c) for c in trips.columns])


@register("k2_unique", f"""{groups_sql('unique', 'o_orderkey', 'orders', 'o_orderkey is not null')}
    union all {groups_sql('unique', 'o_custkey', 'orders', 'o_custkey is not null')}""")
def k2(spark, sf):
    return k.run_checks(feeds.table(spark, sf, "orders"), [k.unique("o_orderkey"), k.unique("o_custkey")])


@register("k3_accepted_values", f"""{_TRIPS} {rows_sql('trip', ('accepted_values', 'service', "service not in ('green', 'yellow')"),
          ('accepted_values', 'payment_type', 'payment_type not in (1, 2, 3)'))}""")
def k3(spark, sf):
    return k.run_checks(feeds.trips(spark, sf, "service", "payment_type"), [
        k.accepted_values("service", ["green", "yellow"]), k.accepted_values("payment_type", [1, 2, 3])])


@register("k4_relationships", f"""with {TRIPS_SQL}, {TRIP_SQL}, {ZONES_SQL}
    select 'relationships' as "check", 'dropoff_location_id' as "column", count(*) filter (where location_id is null) as failed_rows,
      count(*) as total_rows, count(*) filter (where location_id is null) = 0 as passed
    from trip left join zones on dropoff_location_id = location_id""")
def k4(spark, sf):
    trips = feeds.trips(spark, sf, "dropoff_location_id")
    return k.run_checks(trips, [k.relationship("dropoff_location_id", feeds.zones(spark, sf), "location_id")])


@register("k5_unique_combination", groups_sql("unique_combination", "l_orderkey, l_linenumber", "lineitem"))
def k5(spark, sf):
    return k.run_checks(feeds.table(spark, sf, "lineitem"), [k.unique_combination("l_orderkey", "l_linenumber")])


@register("k6_non_negative", rows_sql("customer", ("non_negative", "c_acctbal", "c_acctbal < 0"), ("non_negative", "c_custkey", "c_custkey < 0")))
def k6(spark, sf):
    return k.run_checks(feeds.table(spark, sf, "customer"), [k.non_negative("c_acctbal"), k.non_negative("c_custkey")])


@register("k7_query_equals_value", """
    select 'no_duplicates' as "check", 'duplicates' as "column", cast(n <> 0 as bigint) as failed_rows,
      cast(1 as bigint) as total_rows, n = 0 as passed
    from (select count(*) - count(distinct o_orderkey) as n from orders)""")
def k7(spark, sf):
    return k.scalar_equals("no_duplicates", k.duplicate_count(feeds.table(spark, sf, "orders"), "o_orderkey"), 0)


@register("k8_freshness", """
    select 'freshness' as "check", 'ts' as "column", newest, round(hours, 2) as age_hours,
      case when hours > 48 then 'error' when hours > 24 then 'warn' else 'pass' end as status, hours <= 48 as passed
    from (select max(ts) as newest, floor(epoch(timestamp '2024-02-01 06:00:00' - max(ts))) / 3600.0 as hours from events)""")
def k8(spark, sf):
    return k.freshness(feeds.table(spark, sf, "events"), "ts", "2024-02-01 06:00:00")


@register("k9_gate_outcome", f"""with {MONTHLY_SQL}, results as (
    {groups_sql('unique_combination', 'pickup_zone, revenue_month, service_type', 'monthly')} union all
    {rows_sql('monthly', ('not_null', 'pickup_zone', 'pickup_zone is null'), ('not_null', 'revenue_month', 'revenue_month is null'),
              ('not_null', 'service_type', 'service_type is null'),
              ('accepted_values', 'service_type', "service_type not in ('Green', 'Yellow')"),
              ('not_null', 'revenue_monthly_total_amount', 'revenue_monthly_total_amount is null'),
              ('not_null', 'total_monthly_trips', 'total_monthly_trips is null'))})
    select count(*) as checks, count(*) filter (where not passed) as failed from results""")
def k9(spark, sf):
    # the gate itself raises (assert_all); the query shows what it decides on
    monthly = stored(feeds.monthly(spark, sf), scratch_path(spark, "k9"))
    results = marts.check_monthly_revenue(monthly)
    return results.agg(F.count(F.lit(1)).alias("checks"), F.count_if(~F.col("passed")).alias("failed"))


@register("k10_positive", rows_sql("lineitem", ("positive", "l_discount", "l_discount <= 0"), ("positive", "l_quantity", "l_quantity <= 0")))
def k10(spark, sf):
    return k.run_checks(feeds.table(spark, sf, "lineitem"), [k.positive("l_discount"), k.positive("l_quantity")])


@register("k1_model_checks_of_trips", f"""with {INT_TRIPS_SQL}
    {rows_sql('int_trips', *[('not_null', c, f'{c} is null') for c in ('trip_id', 'service_type', 'pickup_datetime', 'total_amount')],
              ('accepted_values', 'service_type', "service_type not in ('Green', 'Yellow')"))}""")
def k_int_trips(spark, sf):
    return marts.check_int_trips(feeds.int_trips(spark, sf))


@register("k1_model_checks_of_staging", f"""with {STAGED_SQL}
    {rows_sql('stg_green', ('not_null', 'pickup_datetime', 'pickup_datetime is null'))} union all
    {rows_sql('stg_yellow', ('not_null', 'pickup_datetime', 'pickup_datetime is null'))}""")
def k_staging(spark, sf):
    return marts.check_stg_trips(staging.stg_green_tripdata(feeds.green_raw(spark, sf))).unionByName(
        marts.check_stg_trips(staging.stg_yellow_tripdata(feeds.yellow_raw(spark, sf))))


@register("k4_model_checks_of_fact", f"""with {FACT_SQL}
    {rows_sql('fact', *[('not_null', c, f'{c} is null') for c in ('trip_id', 'service_type', 'pickup_datetime', 'total_amount')],
              ('accepted_values', 'service_type', "service_type not in ('Green', 'Yellow')"))} union all
    {rows_sql('fact', ('relationships', 'pickup_location_id', 'pickup_zone is null'),
              ('relationships', 'dropoff_location_id', 'dropoff_zone is null'))}""")
def k_fact(spark, sf):
    fact = stored(feeds.fact(spark, sf), scratch_path(spark, "k4"))
    return marts.check_fct_trips(fact, feeds.zones(spark, sf))
