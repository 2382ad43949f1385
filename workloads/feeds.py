"""Driver tables seen as trip feeds.

A trip is an order line: picked up on the order date at the supplier's nation, dropped off on the ship date at the
customer's nation. Codes are derived so that NULL keys, unreadable codes and codes missing from the lookups occur.
The same column formulas are given to Spark and, as a WITH clause, to the SQL engine.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from farebox.plans import marts, staging
from farebox.schemas import AMOUNTS

# amounts are products of cents and hundredths, rounded half up to cents in whole numbers
_CENTS = "floor(l_extendedprice * 100 + 0.5)"
# column: (formula, table besides lineitem it comes from)
_TRIP = {
    "vendorid": ("nullif(l_linenumber, 7)", None),
    "pickup": ("o_orderdate", "orders"),
    "dropoff": ("l_shipdate", None),
    "ratecode": ("case when l_returnflag = 'R' then 'unknown' else cast(l_linenumber as string) end", None),
    "flag": ("l_returnflag", None),
    "pu": ("s_nationkey", "supplier"),
    "do": ("c_nationkey", "customer"),
    "passengers": ("cast(l_linenumber as bigint)", None),
    "distance": ("l_quantity", None),
    "triptype": ("case when o_orderstatus = 'P' then '2' when o_orderstatus = 'F' then 'x' else '1' end", "orders"),
    "fare": ("l_extendedprice", None),
    "extra": ("l_discount", None),
    "mta": ("l_tax", None),
    "tip": (f"floor(({_CENTS} * floor(l_discount * 100 + 0.5) + 50) / 100) / 100", None),
    "total": (f"floor(({_CENTS} * (100 + floor(l_tax * 100 + 0.5)) + 50) / 100) / 100", None),
    "payment": ("nullif(cast(substr(o_orderpriority, 1, 1) as int), 5)", "orders"),
    "service": ("case when l_linestatus = 'O' then 'green' else 'yellow' end", None),
}
_JOINS = {
    "orders": ("lineitem", "l_orderkey", "o_orderkey"),
    "supplier": ("lineitem", "l_suppkey", "s_suppkey"),
    "customer": ("orders", "o_custkey", "c_custkey"),
}

# payment codes listed by the lookup; 0 (from NULL) and 4 are not
PAYMENT_TYPES = [(1, "urgent"), (2, "high"), (3, "medium")]

TRIPS_SQL = (
    "feed as (select " + ", ".join(f"{sql} as {name}" for name, (sql, _) in _TRIP.items())
    + " from lineitem join orders on l_orderkey = o_orderkey join supplier on l_suppkey = s_suppkey"
    + " join customer on o_custkey = c_custkey)"
)
ZONES_SQL = (
    "zones as (select n_nationkey as location_id, r_name as borough, n_name as zone,"
    " case when r_name = 'EUROPE' then 'Yellow Zone' else 'Boro Zone' end as service_zone"
    " from nation join region on n_regionkey = r_regionkey where r_name <> 'MIDDLE EAST')"
)
PAYMENTS_SQL = (
    "payments(payment_type, description) as (values " + ", ".join(f"({k}, '{v}')" for k, v in PAYMENT_TYPES) + ")"
)
TRIP_SQL = (
    "trip as (select vendorid as vendor_id, pickup as pickup_datetime, dropoff as dropoff_datetime,"
    " pu as pickup_location_id, \"do\" as dropoff_location_id, distance as trip_distance, passengers as passenger_count,"
    " cast(fare as decimal(18,2)) as fare_amount, cast(tip as decimal(18,2)) as tip_amount,"
    " cast(total as decimal(18,2)) as total_amount, payment as payment_type, service from feed)"
)


_schemas: dict[str, T.StructType] = {}


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    """A driver table; its footer is read for the schema once per process."""
    path = f"{sf}/{name}.parquet"
    if path not in _schemas:
        _schemas[path] = spark.read.parquet(path).schema
    return spark.read.schema(_schemas[path]).parquet(path)


def feed(spark: SparkSession, sf: str, columns: list[str]) -> DataFrame:
    """The asked trip columns; joins only the tables they come from, customers to orders, of which there are fewer than lines."""
    needed = {_TRIP[c][1] for c in columns} - {None}
    if "customer" in needed:
        needed.add("orders")
    joined = {name: table(spark, sf, name) for name in {"lineitem"} | needed}
    for to in ("orders", "lineitem"):
        for name, (at, left, right) in _JOINS.items():
            if at == to and name in needed:
                joined[to] = joined[to].join(joined[name], F.col(left) == F.col(right))
    return joined["lineitem"].select(*[F.expr(_TRIP[c][0]).alias(c) for c in columns])


# one feed column per column of the unified trip
_UNIFIED = {
    "vendor_id": "vendorid", "pickup_datetime": "pickup", "dropoff_datetime": "dropoff", "pickup_location_id": "pu",
    "dropoff_location_id": "do", "trip_distance": "distance", "passenger_count": "passengers",
    "fare_amount": "fare", "tip_amount": "tip", "total_amount": "total", "payment_type": "payment",
    "service": "service",
}


def trips(spark: SparkSession, sf: str, *columns: str) -> DataFrame:
    """Trips with the unified names, amounts as decimals of cents."""
    df = feed(spark, sf, [_UNIFIED[c] for c in columns])
    return df.select(*[
        F.col(_UNIFIED[c]).cast("decimal(18,2)").alias(c) if c.endswith("_amount") else F.col(_UNIFIED[c]).alias(c)
        for c in columns
    ])


def zone_lookup(spark: SparkSession, sf: str, skipped_region: str = "MIDDLE EAST") -> DataFrame:
    """Zones of four of the five regions; trips of the fifth have no zone."""
    return (
        table(spark, sf, "nation").join(table(spark, sf, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
        .where(F.col("r_name") != skipped_region)
        .select(
            F.col("n_nationkey").alias("LocationID"), F.col("r_name").alias("Borough"), F.col("n_name").alias("Zone"),
            F.when(F.col("r_name") == "EUROPE", "Yellow Zone").otherwise("Boro Zone").alias("service_zone"),
        )
    )


def zones(spark: SparkSession, sf: str) -> DataFrame:
    return marts.dim_zones(zone_lookup(spark, sf))


def payment_types(spark: SparkSession) -> DataFrame:
    rows = ", ".join(f"({code}, '{name}')" for code, name in PAYMENT_TYPES)
    return spark.sql(f"select * from values {rows} as payments(payment_type, description)")


def payment_lookup(spark: SparkSession) -> DataFrame:
    return payment_types(spark).toDF("payment_type_id", "payment_type_name")


def green_raw(spark: SparkSession, sf: str) -> DataFrame:
    """Green feed with its published column names."""
    return _raw(spark, sf, "green", "lpep").select("*", F.lit(0.0).alias("ehail_fee"), F.col("triptype").alias("trip_type"))


def yellow_raw(spark: SparkSession, sf: str) -> DataFrame:
    """Yellow feed with its published column names; rate codes are whole here."""
    return _raw(spark, sf, "yellow", "tpep").withColumn("RatecodeID", F.col("passenger_count").cast("int"))


def _raw(spark: SparkSession, sf: str, service: str, prefix: str) -> DataFrame:
    df = feed(spark, sf, list(_TRIP)).where(F.col("service") == service).drop("service")
    return df.select(
        F.col("vendorid").alias("VendorID"), F.col("pickup").alias(f"{prefix}_pickup_datetime"),
        F.col("dropoff").alias(f"{prefix}_dropoff_datetime"), F.col("ratecode").alias("RatecodeID"),
        F.col("flag").alias("store_and_fwd_flag"), F.col("pu").alias("PULocationID"), F.col("do").alias("DOLocationID"),
        F.col("passengers").alias("passenger_count"), F.col("distance").alias("trip_distance"),
        F.col("fare").alias("fare_amount"), "extra", F.col("mta").alias("mta_tax"), F.col("tip").alias("tip_amount"),
        F.lit(0.0).alias("tolls_amount"), F.lit(0.3).alias("improvement_surcharge"),
        F.col("total").alias("total_amount"), F.col("payment").alias("payment_type"), "triptype",
    )


def fhv_raw(spark: SparkSession, sf: str) -> DataFrame:
    """For-hire feed from the events; some location codes are not numbers."""
    return table(spark, sf, "events").select(
        F.expr("nullif(event_type, 'error')").alias("dispatching_base_num"), F.col("ts").alias("pickup_datetime"),
        F.col("ts").alias("dropOff_datetime"), F.col("user_id").cast("string").alias("PUlocationID"),
        F.expr("case when event_type = 'click' then 'none' else cast(user_id as string) end").alias("DOlocationID"),
        F.lit(None).cast("string").alias("SR_Flag"), F.col("props").alias("Affiliated_base_number"),
    )


_NUM = "decimal(38,9)"
_STAGED_MONEY = (
    f"cast(distance as {_NUM}) as trip_distance, cast(fare as {_NUM}) as fare_amount, cast(extra as {_NUM}) as extra,"
    f" cast(mta as {_NUM}) as mta_tax, cast(tip as {_NUM}) as tip_amount, cast(0 as {_NUM}) as tolls_amount,"
    f" cast(0 as {_NUM}) as ehail_fee, cast(0.3 as {_NUM}) as improvement_surcharge, cast(total as {_NUM}) as total_amount"
)
_STAGED_IDS = "pu as pickup_location_id, \"do\" as dropoff_location_id, pickup as pickup_datetime, dropoff as dropoff_datetime"
STAGED_SQL = f"""{TRIPS_SQL},
stg_green as (select vendorid as vendor_id, try_cast(ratecode as int) as rate_code_id, {_STAGED_IDS},
  flag as store_and_fwd_flag, passengers as passenger_count, try_cast(triptype as int) as trip_type, {_STAGED_MONEY},
  payment as payment_type, 'Green' as service_type from feed where service = 'green' and vendorid is not null),
stg_yellow as (select vendorid as vendor_id, cast(passengers as int) as rate_code_id, {_STAGED_IDS},
  flag as store_and_fwd_flag, passengers as passenger_count, 1 as trip_type, {_STAGED_MONEY},
  payment as payment_type, 'Yellow' as service_type from feed where service = 'yellow' and vendorid is not null),
unioned as (select * from stg_green union all by name select * from stg_yellow)"""

_KEY_TEXT = " || '-' || ".join([
    "cast(vendor_id as varchar)", "cast(pickup_datetime as varchar)", "cast(pickup_location_id as varchar)", "service_type"
])
# ties in drop-off are settled by the remaining columns, in the order the engine keeps them
INT_TRIPS_SQL = f"""{STAGED_SQL}, {PAYMENTS_SQL},
kept as (select * from unioned qualify row_number() over (
  partition by vendor_id, pickup_datetime, pickup_location_id, service_type
  order by dropoff_datetime, vendor_id, rate_code_id nulls last, pickup_location_id, dropoff_location_id,
    pickup_datetime, store_and_fwd_flag, passenger_count, trip_distance, trip_type nulls last, fare_amount, extra,
    mta_tax, tip_amount, tolls_amount, ehail_fee, improvement_surcharge, total_amount, payment_type nulls last) = 1),
int_trips as (select md5({_KEY_TEXT}) as trip_id, k.* exclude (payment_type),
  coalesce(k.payment_type, 0) as payment_type, coalesce(p.description, 'Unknown') as payment_type_description
  from kept k left join payments p on coalesce(k.payment_type, 0) = p.payment_type)"""
FACT_SQL = f"""{INT_TRIPS_SQL}, {ZONES_SQL},
fact as (select t.*, pz.borough as pickup_borough, pz.zone as pickup_zone, dz.borough as dropoff_borough,
  dz.zone as dropoff_zone, date_diff('minute', pickup_datetime, dropoff_datetime) as trip_duration_minutes
  from int_trips t left join zones pz on t.pickup_location_id = pz.location_id
  left join zones dz on t.dropoff_location_id = dz.location_id)"""
_MONTHLY_PARTS = ", ".join(
    f"sum({source}) as revenue_monthly_{part}" for part, source in
    [(p, "fare_amount" if p == "fare" else p) for p in marts.REVENUE_PARTS]
)
MONTHLY_SQL = f"""{FACT_SQL},
monthly as (select coalesce(pickup_zone, 'Unknown Zone') as pickup_zone,
  cast(date_trunc('month', pickup_datetime) as date) as revenue_month, service_type, {_MONTHLY_PARTS},
  count(trip_id) as total_monthly_trips, avg(passenger_count) as avg_monthly_passenger_count,
  avg(trip_distance) as avg_monthly_trip_distance
  from fact group by coalesce(pickup_zone, 'Unknown Zone'), cast(date_trunc('month', pickup_datetime) as date), service_type)"""


def unioned(spark: SparkSession, sf: str) -> DataFrame:
    return marts.int_trips_unioned(
        staging.stg_green_tripdata(green_raw(spark, sf)), staging.stg_yellow_tripdata(yellow_raw(spark, sf))
    )


def int_trips(spark: SparkSession, sf: str) -> DataFrame:
    uncast = marts.int_trips_unioned(
        staging.stg_green_tripdata(green_raw(spark, sf), uncast=AMOUNTS),
        staging.stg_yellow_tripdata(yellow_raw(spark, sf), uncast=AMOUNTS),
    )
    return marts.int_trips(uncast, payment_types(spark))


def fact(spark: SparkSession, sf: str) -> DataFrame:
    return marts.fct_trips(int_trips(spark, sf), zones(spark, sf))


def monthly(spark: SparkSession, sf: str) -> DataFrame:
    return marts.monthly_zone_revenue(int_trips(spark, sf), zones(spark, sf))


# ---- events as a trip stream and as paged trips ----

EVENTS_SQL = (
    "trip_events as (select ts as event_timestamp, event_type as location, value as tip_amount, value as trip_distance,"
    " user_id, event_id from events)"
)


def trip_events(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "events").select(
        F.col("ts").cast("timestamp").alias("event_timestamp"), F.col("event_type").alias("location"),
        F.col("value").alias("tip_amount"), F.col("value").alias("trip_distance"), "user_id", "event_id",
    )


def paged_trips(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "events").select(
        F.col("ts").alias("trip_pickup_date_time"), F.col("value").cast("decimal(18,2)").alias("tip_amt"),
        F.col("event_type").alias("payment_type"),
    )


# ---- trips as the incremental load sees them ----

INGESTED_SQL = (
    "ingested as (select vendorid as vendor_id, pickup as pickup_datetime, dropoff as dropoff_datetime,"
    " passengers as passenger_count, distance - 1 as trip_distance, pu as pu_location_id, \"do\" as do_location_id,"
    " payment as payment_type, fare as fare_amount, tip as tip_amount, total as total_amount, service as taxi_type,"
    " dropoff as extracted_at from feed)"
)


def ingested(spark: SparkSession, sf: str) -> DataFrame:
    """Ingestion table: every trip once; extraction time varies with the drop-off."""
    return feed(spark, sf, list(_TRIP)).select(
        F.col("vendorid").alias("vendor_id"), F.col("pickup").alias("pickup_datetime"),
        F.col("dropoff").alias("dropoff_datetime"), F.col("passengers").alias("passenger_count"),
        (F.col("distance") - 1).alias("trip_distance"), F.col("pu").alias("pu_location_id"),
        F.col("do").alias("do_location_id"), F.col("payment").alias("payment_type"), F.col("fare").alias("fare_amount"),
        F.col("tip").alias("tip_amount"), F.col("total").alias("total_amount"), F.col("service").alias("taxi_type"),
        F.col("dropoff").alias("extracted_at"),
    )
