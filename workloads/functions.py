"""Scalar functions."""

from pyspark.sql import functions as F

from farebox.functions import (
    day_of,
    double_text,
    hours_between,
    message_text,
    minute_boundaries,
    month_start,
    parse_event_time,
    row_id,
    surrogate_key,
    tip_bucket,
    tip_bucket_rank,
    vendor_name,
)
from farebox.functions.hashing import SURROGATE_NULL
from workloads import feeds
from workloads.aggregates import BUCKET_SQL, RANK_SQL
from workloads.feeds import TRIPS_SQL
from workloads.registry import register

_FEED = f"with {TRIPS_SQL}"


def _text(column: str) -> str:
    return f"regexp_replace(cast({column} as varchar), '\\.0$', '')"


def _parts(sep: str, null: str, *columns: str) -> str:
    return f" || '{sep}' || ".join(f"coalesce({c}, '{null}')" for c in columns)


def _v(column: str) -> str:
    return f"cast({column} as varchar)"


F2_SQL = "md5(" + _parts("", "", _v("vendorid"), _v("pickup"), _v("dropoff"), _v("pu"), _v('"do"'), _text("fare"), _text("distance")) + ")"
F4_SQL = "md5(" + _parts(
    "-", "", _v("vendorid"), _v("pickup"), _v("dropoff"), _v("pu"), _v('"do"'), _text("fare"), _text("tip"),
    _text("total"), "service") + ")"


def flow_row_id():
    """Unseparated id of seven fields."""
    return row_id("vendorid", "pickup", "dropoff", "pu", "do", double_text("fare"), double_text("distance"), sep="")


@register("f1_surrogate_key", f"""{_FEED}
    select vendorid, pickup, pu, service, md5({_parts('-', SURROGATE_NULL, _v('vendorid'), _v('pickup'), _v('pu'), 'service')}) as trip_id from feed""")
def f1(spark, sf):
    keys = ["vendorid", "pickup", "pu", "service"]
    return feeds.feed(spark, sf, keys).select(*keys, surrogate_key(*keys).alias("trip_id"))


_SEVEN = ["vendorid", "pickup", "dropoff", "pu", "do", "fare", "distance"]


@register("f2_unseparated_row_id", f"{_FEED} select fare, distance, {F2_SQL} as unique_row_id from feed")
def f2(spark, sf):
    return feeds.feed(spark, sf, _SEVEN).select("fare", "distance", flow_row_id().alias("unique_row_id"))


@register("f3_row_id_as_bytes", f"""{_FEED}
    select fare, upper(md5({_parts('', '', _v('vendorid'), _v('pickup'), _v('dropoff'), _v('pu'), _v('"do"'))})) as unique_row_id, 16 as id_bytes from feed""")
def f3(spark, sf):
    digest = row_id(*_SEVEN[:5], sep="", as_bytes=True)
    return feeds.feed(spark, sf, _SEVEN).select(
        "fare", F.hex(digest).alias("unique_row_id"), F.octet_length(digest).alias("id_bytes"))


@register("f4_separated_row_id", f"{_FEED} select fare, tip, total, {F4_SQL} as trip_id from feed")
def f4(spark, sf):
    df = feeds.feed(spark, sf, ["vendorid", "pickup", "dropoff", "pu", "do", "fare", "tip", "total", "service"])
    key = row_id("vendorid", "pickup", "dropoff", "pu", "do", *[double_text(c) for c in ("fare", "tip", "total")], "service")
    return df.select("fare", "tip", "total", key.alias("trip_id"))


@register("f5_default_for_null", f"{_FEED} select coalesce(payment, 0) as payment, coalesce(vendorid, -1) as vendor, count(*) as n from feed group by 1, 2")
def f5(spark, sf):
    return feeds.feed(spark, sf, ["payment", "vendorid"]).groupBy(
        F.coalesce("payment", F.lit(0)).alias("payment"), F.coalesce("vendorid", F.lit(-1)).alias("vendor")
    ).agg(F.count(F.lit(1)).alias("n"))


@register("f6_cast_and_safe_cast", f"""{_FEED}
    select try_cast(triptype as int) as trip_type, cast(passengers as int) as passengers, count(*) as n from feed group by 1, 2""")
def f6(spark, sf):
    return feeds.feed(spark, sf, ["triptype", "passengers"]).groupBy(
        F.col("triptype").try_cast("int").alias("trip_type"), F.col("passengers").cast("int").alias("passengers")
    ).agg(F.count(F.lit(1)).alias("n"))


@register("f7_vendor_name", f"""{_FEED}
    select vendorid, case vendorid when 1 then 'Creative Mobile Technologies' when 2 then 'VeriFone Inc.'
      when 4 then 'Unknown/Other' end as vendor_name, count(*) as n from feed group by 1, 2""")
def f7(spark, sf):
    return feeds.feed(spark, sf, ["vendorid"]).groupBy("vendorid", vendor_name("vendorid").alias("vendor_name")).agg(
        F.count(F.lit(1)).alias("n"))


@register("f8_minute_boundaries", """
    select event_id, date_diff('minute', ts, ts + to_microseconds(cast(round(value * 1000) as bigint) * 1000)) as minutes,
      date_diff('minute', ts + to_microseconds(cast(round(value * 1000) as bigint) * 1000), ts) as back from events""")
def f8(spark, sf):
    later = F.expr("cast(timestamp_micros(unix_micros(cast(ts as timestamp)) + cast(round(value * 1000) as bigint) * 1000) as timestamp_ntz)")
    events = feeds.table(spark, sf, "events").select("event_id", "ts", later.alias("later"))
    return events.select(
        "event_id", minute_boundaries("ts", "later").alias("minutes"), minute_boundaries("later", "ts").alias("back"))


@register("f9_hours_between", f"{_FEED} select distance, (epoch(dropoff) - epoch(pickup)) / 3600 as hours from feed")
def f9(spark, sf):
    return feeds.feed(spark, sf, ["distance", "pickup", "dropoff"]).select(
        "distance", hours_between("pickup", "dropoff").alias("hours"))


@register("f10_month_start", "select cast(date_trunc('month', ts) as date) as month, event_id from events")
def f10(spark, sf):
    return feeds.table(spark, sf, "events").select(month_start("ts").alias("month"), "event_id")


@register("f11_day", "select cast(ts as date) as day, event_id from events")
def f11(spark, sf):
    return feeds.table(spark, sf, "events").select(day_of("ts").alias("day"), "event_id")


@register("f12_formatted_times", """
    select event_id, strftime(ts, '%Y-%m') as month, strftime(ts, '%Y-%m-%d') as day, strftime(ts, '%m-%Y') as month_year,
      strftime(ts, '%Y-%m-%d %H:%M:%S') as second from events""")
def f12(spark, sf):
    formats = {"month": "yyyy-MM", "day": "yyyy-MM-dd", "month_year": "MM-yyyy", "second": "yyyy-MM-dd HH:mm:ss"}
    return feeds.table(spark, sf, "events").select(
        "event_id", *[F.date_format("ts", fmt).alias(name) for name, fmt in formats.items()])


@register("f13_parsed_times", """
    select event_id, case when event_type <> 'error' then date_trunc('second', ts) end as event_timestamp from events""")
def f13(spark, sf):
    text = F.when(F.col("event_type") == "error", "no time").otherwise(F.date_format("ts", "yyyy-MM-dd HH:mm:ss"))
    return feeds.table(spark, sf, "events").select("event_id", parse_event_time(text).alias("event_timestamp"))


@register("f14_rounded", "select l_orderkey, round(cast(l_extendedprice as decimal(12,2)) * 7 / 3, 2)::double as rounded from lineitem")
def f14(spark, sf):
    price = F.col("l_extendedprice").cast("decimal(12,2)").cast("double")
    return feeds.table(spark, sf, "lineitem").select("l_orderkey", F.round(price * 7 / 3, 2).alias("rounded"))


@register("f15_tip_classes", f"""with rows as (select event_id, nullif(value - 5, 0) as tip_amt from events)
    select event_id, {BUCKET_SQL} as bucket, {RANK_SQL} as sort_order from rows""")
def f15(spark, sf):
    rows = feeds.table(spark, sf, "events").select("event_id", F.expr("nullif(value - 5, 0)").alias("tip_amt"))
    return rows.select("event_id", tip_bucket("tip_amt").alias("bucket"), tip_bucket_rank("tip_amt").alias("sort_order"))


@register("f16_text_concat", f"{_FEED} select distance, cast(vendorid as varchar) || '/' || flag as both_parts, coalesce(cast(vendorid as varchar), '') || flag as filled from feed")
def f16(spark, sf):
    vendor = F.col("vendorid").cast("string")
    return feeds.feed(spark, sf, ["distance", "vendorid", "flag"]).select(
        "distance", F.concat(vendor, F.lit("/"), "flag").alias("both_parts"),
        F.concat(F.coalesce(vendor, F.lit("")), "flag").alias("filled"))


@register("f17_filled_nulls", f"{_FEED} select distance, coalesce(vendorid, 0) as vendorid, coalesce(payment, 0) as payment from feed")
def f17(spark, sf):
    return feeds.feed(spark, sf, ["distance", "vendorid", "payment"]).na.fill(0, ["vendorid", "payment"])


@register("f18_json_round_trip", """
    select event_id, cast(json_extract_string(props, '$.k') as bigint) as k, nullif(value, 1.0) as value from events""")
def f18(spark, sf):
    events = feeds.table(spark, sf, "events").withColumn("value", F.expr("nullif(value, 1.0)"))
    sent = events.select("event_id", "props", message_text("event_id", "value").alias("message"))
    back = F.from_json("message", "event_id long, value double")
    return sent.select("event_id", F.from_json("props", "k long")["k"].alias("k"), back["value"].alias("value"))


@register("f19_arithmetic", "select event_id, value * 100.0 / 8 as share, (value - 1) / 2 as half from events")
def f19(spark, sf):
    return feeds.table(spark, sf, "events").select(
        "event_id", (F.col("value") * F.lit(100.0) / 8).alias("share"), ((F.col("value") - 1) / 2).alias("half"))


@register("f20_hex_digest", "select event_id, md5(props) as digest from events")
def f20(spark, sf):
    return feeds.table(spark, sf, "events").select("event_id", F.md5("props").alias("digest"))
