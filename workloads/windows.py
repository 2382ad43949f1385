"""Window operators."""

from pyspark.sql import functions as F

from farebox.operators.aggregates import share_of_total
from farebox.operators.dedup import keep_first, keep_latest
from farebox.operators.sessions import session_counts
from workloads import feeds
from workloads.feeds import EVENTS_SQL, TRIPS_SQL, TRIP_SQL
from workloads.registry import register

_TRIPS = f"with {TRIPS_SQL}, {TRIP_SQL}"
_KEY = ["vendor_id", "pickup_datetime", "pickup_location_id", "service"]
_REST = ["dropoff_datetime", "trip_distance", "fare_amount"]


@register("d1_dedup_keep_first", f"""{_TRIPS}
    select {', '.join(_KEY + _REST[:2])}, fare_amount::double as fare_amount from trip
    qualify row_number() over (partition by {', '.join(_KEY)}
      order by dropoff_datetime, trip_distance, fare_amount) = 1""")
def d1(spark, sf):
    return keep_first(feeds.trips(spark, sf, *_KEY, *_REST), _KEY, "dropoff_datetime", ["trip_distance", "fare_amount"])


@register("d2_dedup_keep_latest", f"""{_TRIPS}
    select {', '.join(_KEY + _REST[:2])}, fare_amount::double as fare_amount from trip
    qualify row_number() over (partition by {', '.join(_KEY)}
      order by dropoff_datetime desc, trip_distance, fare_amount) = 1""")
def d2(spark, sf):
    return keep_latest(feeds.trips(spark, sf, *_KEY, *_REST), _KEY, "dropoff_datetime", ["trip_distance", "fare_amount"])


@register("d3_share_of_total", """
    select event_type, count(*) as trips, cast(round(count(*) * 100.0 / sum(count(*)) over (), 2) as double) as pct
    from events group by 1""")
def d3(spark, sf):
    return share_of_total(feeds.table(spark, sf, "events"), "event_type")


@register("d4_share_of_one_class", """
    select * from (select event_type, count(*) as trips,
      cast(round(count(*) * 100.0 / sum(count(*)) over (), 2) as double) as pct from events group by 1)
    where event_type = 'purchase'""")
def d4(spark, sf):
    return share_of_total(feeds.table(spark, sf, "events"), "event_type").where(F.col("event_type") == "purchase")


def session_sql(key: str, minutes: int) -> str:
    """Sessions by lag and running sum, the form SQL engines use."""
    return f"""with {EVENTS_SQL},
    flagged as (select *, case when event_timestamp <= lag(event_timestamp) over w + interval {minutes} minute then 0 else 1 end as starts
      from trip_events window w as (partition by {key} order by event_timestamp, event_id)),
    numbered as (select *, sum(starts) over (partition by {key} order by event_timestamp, event_id) as session from flagged)
    select {key}, min(event_timestamp) as window_start, max(event_timestamp) + interval {minutes} minute as window_end,
      count(*) as num_trips from numbered group by {key}, session"""


@register("d5_session_assignment", session_sql("location", 30))
def d5(spark, sf):
    return session_counts(feeds.trip_events(spark, sf), "location", "event_timestamp", 30 * 60)


@register("d5_session_per_user", session_sql("user_id", 720))
def d5_users(spark, sf):
    return session_counts(feeds.trip_events(spark, sf), "user_id", "event_timestamp", 720 * 60)
