"""Trips unified, enriched and deduplicated; dimensions; fact trips; monthly revenue."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from farebox.functions import minute_boundaries, month_start, surrogate_key, vendor_name
from farebox.operators.checks import (
    accepted_values,
    not_null,
    relationship,
    run_checks,
    unique,
    unique_combination,
)
from farebox.operators.conform import with_constants
from farebox.operators.dedup import keep_first
from farebox.schemas import AMOUNTS, NUMERIC

SERVICES = ["Green", "Yellow"]
TRIP_KEY = ["vendor_id", "pickup_datetime", "pickup_location_id", "service_type"]
UNKNOWN_PAYMENT = 0
UNKNOWN_LABEL = "Unknown"
UNKNOWN_ZONE = "Unknown Zone"
REVENUE_PARTS = [
    "fare", "extra", "mta_tax", "tip_amount", "tolls_amount", "ehail_fee", "improvement_surcharge", "total_amount"
]


def int_trips_unioned(green: DataFrame, yellow: DataFrame) -> DataFrame:
    """Both services in one shape. Yellow trips are always street hails (type 1) and carry no e-hail fee.

    Amounts may come uncast from staging (``uncast=AMOUNTS``); ``int_trips`` casts them. One that only a single feed has
    as a double is cast here, so that the other's decimals don't become doubles.
    """
    green = with_constants(green, service_type=F.lit("Green"))
    yellow = with_constants(
        yellow,
        trip_type=F.lit(1).cast("int"),
        ehail_fee=F.lit(0).cast(green.schema["ehail_fee"].dataType),
        service_type=F.lit("Yellow"),
    )
    mixed = {c: F.col(c).cast(NUMERIC) for c in AMOUNTS if green.schema[c].dataType != yellow.schema[c].dataType}
    return green.withColumns(mixed).unionByName(yellow.withColumns(mixed))


def with_payment_label(
    trips: DataFrame, payment_types: DataFrame, code: Column, default_label: str | None = UNKNOWN_LABEL
) -> DataFrame:
    """Left join of a payment lookup (payment_type, description) on ``code``; unmatched codes get the default."""
    lookup = payment_types.select(F.col("payment_type").alias("_code"), F.col("description").alias("_label"))
    joined = trips.join(lookup, code == F.col("_code"), "left")
    label = F.col("_label") if default_label is None else F.coalesce("_label", F.lit(default_label))
    return joined.withColumn("payment_type_description", label).drop("_code", "_label")


def int_trips(unioned: DataFrame, payment_types: DataFrame) -> DataFrame:
    """One row per (vendor, pickup time, pickup zone, service), the earliest drop-off, with id and payment label.

    Rows are reduced before they are joined and hashed: the key decides both, so the result is the same and the
    md5 is computed once per kept trip. Uncast amounts are sorted and shuffled as the doubles of the feed (a primitive
    comparison and 8 bytes each, where a wide decimal takes an object and 24) and cast once per kept trip.
    """
    kept = keep_first(unioned, sorted(TRIP_KEY, key="pickup_datetime".__ne__), "dropoff_datetime")
    kept = kept.withColumns({c: F.col(c).cast(NUMERIC) for c in AMOUNTS})
    code = F.coalesce("payment_type", F.lit(UNKNOWN_PAYMENT))
    labelled = with_payment_label(kept, payment_types, code).withColumn("payment_type", code)
    return labelled.select(surrogate_key(*TRIP_KEY).alias("trip_id"), "*")


def dim_zones(zone_lookup: DataFrame) -> DataFrame:
    return zone_lookup.select(F.col("LocationID").alias("location_id"), "borough", "zone", "service_zone")


def dim_payment_types(lookup: DataFrame) -> DataFrame:
    return lookup.select(F.col("payment_type").alias("payment_type_id"), "description")


def dim_vendors(trips: DataFrame) -> DataFrame:
    """Vendors that occur in trips; the name is looked up after the distinct, once per vendor."""
    return trips.select("vendor_id").distinct().withColumn("vendor_name", vendor_name("vendor_id"))


def with_zones(trips: DataFrame, zones: DataFrame, how: str = "left") -> DataFrame:
    """Zone and borough of both ends: the same dimension joined twice under two roles."""
    zones = zones.select("location_id", "borough", "zone")
    for role in ("pickup", "dropoff"):
        role_zones = zones.select(
            F.col("location_id").alias(f"_{role}"),
            F.col("borough").alias(f"{role}_borough"),
            F.col("zone").alias(f"{role}_zone"),
        )
        trips = trips.join(role_zones, F.col(f"{role}_location_id") == F.col(f"_{role}"), how).drop(f"_{role}")
    return trips


# Column order of the fact table.
FACT_COLUMNS = (
    "trip_id vendor_id service_type rate_code_id pickup_location_id pickup_borough pickup_zone dropoff_location_id "
    "dropoff_borough dropoff_zone pickup_datetime dropoff_datetime store_and_fwd_flag passenger_count trip_distance "
    "trip_type trip_duration_minutes fare_amount extra mta_tax tip_amount tolls_amount ehail_fee "
    "improvement_surcharge total_amount payment_type payment_type_description"
).split()


def fct_trips(trips: DataFrame, zones: DataFrame) -> DataFrame:
    """Trips with zones of both ends (unknown zones stay, as NULL) and the duration in minute boundaries."""
    return with_zones(trips, zones).withColumn(
        "trip_duration_minutes", minute_boundaries("pickup_datetime", "dropoff_datetime")
    ).select(*FACT_COLUMNS)


def fct_monthly_zone_revenue(fact: DataFrame) -> DataFrame:
    """Revenue per (pickup zone, month, service).

    Groups by the defaulted zone name, so trips without zone and trips of a zone of that very name are one group.
    """
    sources = {"fare": "fare_amount"}
    return fact.groupBy(
        F.coalesce("pickup_zone", F.lit(UNKNOWN_ZONE)).alias("pickup_zone"),
        month_start("pickup_datetime").alias("revenue_month"),
        "service_type",
    ).agg(
        *[F.sum(sources.get(part, part)).alias(f"revenue_monthly_{part}") for part in REVENUE_PARTS],
        F.count("trip_id").alias("total_monthly_trips"),
        F.avg("passenger_count").alias("avg_monthly_passenger_count"),
        F.avg("trip_distance").alias("avg_monthly_trip_distance"),
    )


def monthly_zone_revenue(trips: DataFrame, zones: DataFrame) -> DataFrame:
    """The rows of ``fct_monthly_zone_revenue(fct_trips(trips, zones))`` without a join per trip.

    Trips are summed per pickup location first; the zone's name is looked up for those sums, which are then added up by
    the shown name. Location ids of the zones must be unique, as ``check_dim_zones`` demands.
    """
    column = {"fare": "fare_amount"}
    means = ("passenger_count", "trip_distance")
    by_location = trips.groupBy("pickup_location_id", month_start("pickup_datetime").alias("revenue_month"), "service_type").agg(
        *[F.sum(column.get(part, part)).alias(part) for part in REVENUE_PARTS], F.count("trip_id").alias("trips"),
        *[f(c).alias(f"{f.__name__}_{c}") for c in means for f in (F.sum, F.count)])
    names = zones.select(F.col("location_id").alias("_location"), F.coalesce("zone", F.lit(UNKNOWN_ZONE)).alias("_zone"))
    named = by_location.join(names, F.col("pickup_location_id") == F.col("_location"), "left")
    return named.groupBy(F.coalesce("_zone", F.lit(UNKNOWN_ZONE)).alias("pickup_zone"), "revenue_month", "service_type").agg(
        *[F.sum(part).alias(f"revenue_monthly_{part}") for part in REVENUE_PARTS],
        F.sum("trips").alias("total_monthly_trips"),
        *[(F.sum(f"sum_{c}") / F.nullif(F.sum(f"count_{c}"), F.lit(0))).alias(f"avg_monthly_{c}") for c in means],
    )


def best_zones(monthly: DataFrame, service: str, year: int) -> DataFrame:
    """Zones of a service by revenue of a year, largest first; answered from the monthly table."""
    in_year = F.col("revenue_month").between(F.lit(f"{year}-01-01").cast("date"), F.lit(f"{year}-12-31").cast("date"))
    return (
        monthly.where((F.col("service_type") == service) & in_year)
        .groupBy("pickup_zone").agg(F.sum("revenue_monthly_total_amount").alias("total_rev"))
        .orderBy(F.col("total_rev").desc(), "pickup_zone")
    )


def trips_in_month(monthly: DataFrame, service: str, month: str) -> DataFrame:
    """Trips of a service in one month, summed over the monthly table."""
    return monthly.where(
        (F.col("service_type") == service) & (F.col("revenue_month") == F.lit(month).cast("date"))
    ).agg(F.sum("total_monthly_trips").alias("total_trips"))


# ---- declared checks of the models ----

def stg_trips_checks() -> list:
    return [not_null("pickup_datetime")]


def payment_types_checks() -> list:
    return [unique("payment_type"), not_null("payment_type")]


def int_trips_checks() -> list:
    return [
        not_null("trip_id"), not_null("service_type"), accepted_values("service_type", SERVICES),
        not_null("pickup_datetime"), not_null("total_amount"),
    ]


def fct_trips_checks(zones: DataFrame) -> list:
    return [
        not_null("trip_id"), accepted_values("service_type", SERVICES), not_null("service_type"),
        not_null("pickup_datetime"), not_null("total_amount"),
        relationship("pickup_location_id", zones, "location_id"),
        relationship("dropoff_location_id", zones, "location_id"),
    ]


def dim_zones_checks() -> list:
    return [unique("location_id"), not_null("location_id")]


def monthly_revenue_checks() -> list:
    return [
        unique_combination("pickup_zone", "revenue_month", "service_type"),
        not_null("pickup_zone"), not_null("revenue_month"), not_null("service_type"),
        accepted_values("service_type", SERVICES),
        not_null("revenue_monthly_total_amount"), not_null("total_monthly_trips"),
    ]


def check_stg_trips(staged: DataFrame) -> DataFrame:
    return run_checks(staged, stg_trips_checks())


def check_payment_types(lookup: DataFrame) -> DataFrame:
    return run_checks(lookup, payment_types_checks())


def check_int_trips(trips: DataFrame) -> DataFrame:
    return run_checks(trips, int_trips_checks())


def check_fct_trips(fact: DataFrame, zones: DataFrame) -> DataFrame:
    return run_checks(fact, fct_trips_checks(zones))


def check_dim_zones(zones: DataFrame) -> DataFrame:
    return run_checks(zones, dim_zones_checks())


def check_monthly_revenue(monthly: DataFrame) -> DataFrame:
    return run_checks(monthly, monthly_revenue_checks())
