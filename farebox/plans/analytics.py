"""Questions asked of the trip tables, each as one declarative query."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from farebox.functions import (
    between_closed,
    day_of,
    hours_between,
    in_half_open,
    in_month,
    json_fields,
    on_day,
    tip_bucket,
    tip_bucket_rank,
)
from farebox.operators.aggregates import ranked

# ---- trips with pickup_datetime, dropoff_datetime, trip_distance, amounts, location ids ----


def short_trips(trips: DataFrame, start, end, max_distance: float = 1.0) -> DataFrame:
    """Number of trips of at most ``max_distance`` picked up in [start, end)."""
    return trips.where(
        in_half_open("pickup_datetime", start, end) & (F.col("trip_distance") <= max_distance)
    ).agg(F.count(F.lit(1)).alias("short_trips"))


def longest_trip_days(trips: DataFrame, below: float = 100.0, n: int = 5) -> DataFrame:
    """The ``n`` days with the longest trip, trips of ``below`` and more taken as errors."""
    per_day = trips.where(F.col("trip_distance") < below).groupBy(day_of("pickup_datetime").alias("pickup_date")).agg(
        F.max("trip_distance").alias("max_trip_distance")
    )
    return ranked(per_day, [F.col("max_trip_distance").desc(), F.col("pickup_date")], n)


def pickup_zone_revenue(trips: DataFrame, zones: DataFrame, day: str) -> DataFrame:
    """Revenue per pickup zone of one day. Rows are summed per location id before the zone is joined."""
    per_location = trips.where(on_day("pickup_datetime", day)).groupBy("pickup_location_id").agg(
        F.sum("total_amount").alias("amount")
    )
    return (
        per_location.join(zones, F.col("pickup_location_id") == F.col("location_id"))
        .groupBy("zone").agg(F.sum("amount").alias("total_amount"))
    )


def biggest_pickup_zone(trips: DataFrame, zones: DataFrame, day: str) -> DataFrame:
    return ranked(pickup_zone_revenue(trips, zones, day), [F.col("total_amount").desc(), F.col("zone")], 1)


def largest_tip_dropoffs(trips: DataFrame, zones: DataFrame, pickup_zone: str, month: str) -> DataFrame:
    """Largest tip per drop-off zone for trips of a month ('MM-yyyy') from one pickup zone."""
    zones = zones.select("location_id", "zone")
    origin = zones.where(F.col("zone") == pickup_zone).select(F.col("location_id").alias("_from"))
    target = zones.select(F.col("location_id").alias("_to"), F.col("zone").alias("dropoff_zone"))
    per_location = (
        trips.where(in_month("pickup_datetime", month))
        .join(origin, F.col("pickup_location_id") == F.col("_from"))
        .groupBy("dropoff_location_id").agg(F.max("tip_amount").alias("tip"))
    )
    return (
        per_location.join(target, F.col("dropoff_location_id") == F.col("_to"))
        .groupBy("dropoff_zone").agg(F.max("tip").alias("max_tip"))
    )


def largest_tip_dropoff(trips: DataFrame, zones: DataFrame, pickup_zone: str, month: str) -> DataFrame:
    tips = largest_tip_dropoffs(trips, zones, pickup_zone, month)
    return ranked(tips, [F.col("max_tip").desc_nulls_last(), F.col("dropoff_zone")], 1)


def rows_from_files(rows: DataFrame, text: str) -> DataFrame:
    """Rows whose source file name contains ``text``."""
    return rows.where(F.col("filename").contains(text)).agg(F.count(F.lit(1)).alias("row_count"))


def distinct_pickup_zones(trips: DataFrame) -> DataFrame:
    return trips.agg(F.count_distinct("pickup_location_id").alias("pickup_zones"))


def zero_fare_trips(trips: DataFrame) -> DataFrame:
    return trips.where(F.col("fare_amount") == 0).agg(F.count("fare_amount").alias("zero_fares"))


def vendors_between(trips: DataFrame, first_day: str, last_day: str) -> DataFrame:
    """Distinct vendors with a drop-off BETWEEN two days (the last day counts at midnight only)."""
    return trips.where(between_closed("dropoff_datetime", first_day, last_day)).select("vendor_id").distinct()


def trips_on_day(trips: DataFrame, day: str) -> DataFrame:
    return trips.where(on_day("pickup_datetime", day)).agg(F.count(F.lit(1)).alias("trips"))


def longest_trip_hours(trips: DataFrame) -> DataFrame:
    return trips.agg(F.max(hours_between("pickup_datetime", "dropoff_datetime")).alias("max_hours"))


def pickup_zone_counts(trips: DataFrame, zones: DataFrame) -> DataFrame:
    """Trips per pickup zone, counted per location id before the zone is joined."""
    per_location = trips.groupBy("pickup_location_id").agg(F.count("pickup_location_id").alias("n"))
    return (
        per_location.join(zones, F.col("pickup_location_id") == F.col("location_id"))
        .groupBy("zone").agg(F.sum("n").alias("trip_count"))
    )


def least_frequent_zone(trips: DataFrame, zones: DataFrame) -> DataFrame:
    return ranked(pickup_zone_counts(trips, zones), [F.col("trip_count"), F.col("zone")], 1)


# ---- paged trips with trip_pickup_date_time, tip_amt, payment_type ----


def trips_per_period(rows: DataFrame, ts: str, fmt: str, out: str) -> DataFrame:
    """Trips per formatted period of a day or longer ('yyyy-MM', 'yyyy-MM-dd'); the text is made per day, not per row."""
    if set(fmt) & set("HhKkmsSnNAa"):
        raise ValueError(f"{fmt} is finer than a day")
    per_day = rows.groupBy(F.col(ts).cast("date").alias("_day")).agg(F.count(F.lit(1)).alias("n"))
    return per_day.groupBy(F.date_format("_day", fmt).alias(out)).agg(F.sum("n").alias("trips")).orderBy(out)


def date_range(rows: DataFrame, ts: str) -> DataFrame:
    return rows.agg(F.min(ts).alias("earliest"), F.max(ts).alias("latest"))


def tip_summary(rows: DataFrame, tip: str) -> DataFrame:
    return rows.agg(
        F.round(F.sum(tip), 2).alias("total_tips"),
        F.round(F.avg(tip), 2).alias("avg_tip"),
        F.round(F.max(tip), 2).alias("max_tip"),
        F.count_if(F.col(tip) > 0).alias("tippers"),
    )


def tip_histogram(rows: DataFrame, tip: str) -> DataFrame:
    return rows.groupBy(tip_bucket(tip).alias("bucket"), tip_bucket_rank(tip).alias("sort_order")).agg(
        F.count(F.lit(1)).alias("trips")
    ).orderBy("sort_order")


# ---- JSON documents ----


def mean_price_by_brand(products: DataFrame, document: str, brand: str = "brand", price: str = "price") -> DataFrame:
    """Mean price per brand from JSON objects; products without brand are grouped under the missing label."""
    rows = products.select(*json_fields(document, [brand, price]))
    return (
        rows.groupBy(F.col(brand).alias("brand"))
        .agg(F.round(F.avg(F.col(price).try_cast("double")), 2).alias("avg_price"))
        .orderBy(F.col("avg_price").desc_nulls_last(), F.col("brand"))
    )
