"""Joins (J1-J7)."""

from pyspark.sql import functions as F

from farebox.operators.checks import relationship, run_checks
from farebox.plans import marts
from workloads import feeds
from workloads.feeds import PAYMENTS_SQL, TRIPS_SQL, TRIP_SQL, ZONES_SQL
from workloads.registry import register

_WITH = f"with {TRIPS_SQL}, {TRIP_SQL}, {ZONES_SQL}, {PAYMENTS_SQL}"


@register("j1_inner_zone", f"""{_WITH}
    select zone, fare_amount::double as fare_amount from trip join zones on pickup_location_id = location_id""")
def j1(spark, sf):
    trips = feeds.trips(spark, sf, "pickup_location_id", "fare_amount")
    return trips.join(feeds.zones(spark, sf), F.col("pickup_location_id") == F.col("location_id")).select("zone", "fare_amount")


_ROLES = "pickup_zone, pickup_borough, dropoff_zone, dropoff_borough, tip_amount"
_ROLES_SQL = """pz.zone as pickup_zone, pz.borough as pickup_borough, dz.zone as dropoff_zone, dz.borough as dropoff_borough,
    tip_amount::double as tip_amount"""


def _roles(spark, sf, how):
    trips = feeds.trips(spark, sf, "pickup_location_id", "dropoff_location_id", "tip_amount")
    return marts.with_zones(trips, feeds.zones(spark, sf), how).select(*_ROLES.split(", "))


@register("j2_inner_zone_in_two_roles", f"""{_WITH} select {_ROLES_SQL} from trip
    join zones pz on pickup_location_id = pz.location_id join zones dz on dropoff_location_id = dz.location_id""")
def j2(spark, sf):
    return _roles(spark, sf, "inner")


@register("j3_left_zone_in_two_roles", f"""{_WITH} select {_ROLES_SQL} from trip
    left join zones pz on pickup_location_id = pz.location_id left join zones dz on dropoff_location_id = dz.location_id""")
def j3(spark, sf):
    return _roles(spark, sf, "left")


@register("j4_left_payment_with_default", f"""{_WITH}
    select coalesce(t.payment_type, 0) as payment_type, coalesce(description, 'Unknown') as payment_type_description,
      trip_distance from trip t left join payments p on coalesce(t.payment_type, 0) = p.payment_type""")
def j4(spark, sf):
    trips = feeds.trips(spark, sf, "payment_type", "trip_distance")
    code = F.coalesce("payment_type", F.lit(0))
    return marts.with_payment_label(trips, feeds.payment_types(spark), code).withColumn("payment_type", code)


@register("j5_left_payment_without_default", f"""{_WITH}
    select t.payment_type, description as payment_type_description, trip_distance
    from trip t left join payments p on t.payment_type = p.payment_type""")
def j5(spark, sf):
    trips = feeds.trips(spark, sf, "payment_type", "trip_distance")
    return marts.with_payment_label(trips, feeds.payment_types(spark), F.col("payment_type"), default_label=None)


@register("j6_anti_join", """
    select o_orderkey from orders where not exists (
      select 1 from lineitem where l_orderkey = o_orderkey and l_linestatus = 'O')""")
def j6(spark, sf):
    shipped = feeds.table(spark, sf, "lineitem").where("l_linestatus = 'O'").select(F.col("l_orderkey").alias("o_orderkey"))
    return feeds.table(spark, sf, "orders").select("o_orderkey").join(shipped, "o_orderkey", "left_anti")


@register("j7_missing_parents", f"""{_WITH}
    select 'relationships' as "check", 'pickup_location_id' as "column",
      count(*) filter (where pickup_location_id not in (select location_id from zones)) as failed_rows,
      count(pickup_location_id) as total_rows,
      count(*) filter (where pickup_location_id not in (select location_id from zones)) = 0 as passed
    from trip where pickup_location_id is not null""")
def j7(spark, sf):
    trips = feeds.trips(spark, sf, "pickup_location_id")
    return run_checks(trips, [relationship("pickup_location_id", feeds.zones(spark, sf), "location_id")])
