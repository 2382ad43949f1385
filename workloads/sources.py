"""Scans and sources."""

import uuid
from datetime import date, datetime

from pyspark.sql import functions as F
from pyspark.sql import types as T

from farebox import sources
from farebox.functions.times import in_half_open, next_month
from farebox.schemas import ZONE_LOOKUP
from farebox.session import scratch_path
from farebox.sources.file_index import may_hold, read_indexed, refresh
from farebox.streaming import append_windows, count_until_idle, write_messages
from workloads import feeds
from workloads.registry import register

_LINE_COLUMNS = "l_orderkey l_partkey l_linenumber l_quantity l_extendedprice l_discount l_returnflag l_shipdate".split()


@register("s1_read_parquet", "select * from orders")
def s1(spark, sf):
    return sources.read_parquet(spark, f"{sf}/orders.parquet")


@register("s2_pruned_parquet", f"select {', '.join(_LINE_COLUMNS)} from lineitem")
def s2(spark, sf):
    return sources.read_parquet(spark, f"{sf}/lineitem.parquet", columns=_LINE_COLUMNS)


@register("s3_parquet_glob_view", """
    select o_orderstatus, count(*) as orders, min(o_orderdate) as first_order from orders group by o_orderstatus""")
def s3(spark, sf):
    sources.external_view(sources.read_parquet(spark, f"{sf}/order*.parquet"), "external_orders")
    counted = spark.sql(
        "select o_orderstatus, count(*) as orders, min(o_orderdate) as first_order from external_orders group by o_orderstatus"
    )
    spark.catalog.dropTempView("external_orders")
    return counted


def _as_csv(df, name, **options):
    path = scratch_path(df.sparkSession, name)
    df.write.options(header=True, **options).csv(path)
    return path


@register("s4_csv_text", """
    select cast(c_custkey as varchar) as c_custkey, c_name, cast(c_nationkey as varchar) as c_nationkey,
      cast(c_acctbal as varchar) as c_acctbal, c_mktsegment from customer""")
def s4(spark, sf):
    return sources.read_csv(spark, _as_csv(feeds.table(spark, sf, "customer"), "s4"))


@register("s4_csv_inferred", "select * from supplier")
def s4_inferred(spark, sf):
    path = _as_csv(feeds.table(spark, sf, "supplier"), "s4i")
    inferred = sources.read_csv(spark, path, infer=True)
    return inferred.withColumn("s_suppkey", F.col("s_suppkey").cast("long"))


@register("s5_csv_declared_types", """
    select o_orderkey, nullif(cast(substr(o_orderpriority, 1, 1) as bigint), 5) as payment_type, o_totalprice, o_orderdate
    from orders""")
def s5(spark, sf):
    rows = feeds.table(spark, sf, "orders").select(
        "o_orderkey", F.expr("nullif(cast(substr(o_orderpriority, 1, 1) as bigint), 5)").alias("payment_type"),
        "o_totalprice", F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss").alias("o_orderdate"),
    )
    schema = T.StructType([
        T.StructField("o_orderkey", T.LongType()), T.StructField("payment_type", T.LongType()),
        T.StructField("o_totalprice", T.DoubleType()), T.StructField("o_orderdate", T.TimestampType()),
    ])
    return sources.read_csv(spark, _as_csv(rows, "s5"), schema=schema)


@register("s6_gzip_csv_glob", "select o_orderkey, o_custkey, o_orderstatus, o_totalprice from orders")
def s6(spark, sf):
    rows = feeds.table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice")
    path = _as_csv(rows, "s6", compression="gzip")
    read = sources.read_csv(spark, f"{path}/*.csv.gz", infer=True, spread_over=8)
    return read.withColumns({c: F.col(c).cast("long") for c in ("o_orderkey", "o_custkey")})


@register("s7_csv_extra_columns", """
    select s_suppkey, case when s_nationkey <> 3 then s_nationkey end as s_nationkey from supplier""")
def s7(spark, sf):
    rows = feeds.table(spark, sf, "supplier").select(
        "s_suppkey", F.expr("case when s_nationkey = 3 then 'bad' else cast(s_nationkey as string) end").alias("s_nationkey"),
        F.lit("x").alias("unknown_column"),
    )
    schema = T.StructType([T.StructField("s_suppkey", T.LongType()), T.StructField("s_nationkey", T.IntegerType())])
    return sources.read_csv(spark, _as_csv(rows, "s7"), schema=schema)


@register("s8_json_document_rows", "select p_partkey as id, p_brand as brand, p_retailprice as price from part")
def s8(spark, sf):
    item = F.struct(F.col("p_partkey").alias("id"), F.col("p_brand").alias("brand"), F.col("p_retailprice").alias("price"))
    path = scratch_path(spark, "s8")
    feeds.table(spark, sf, "part").select(F.array(item).alias("products")).write.json(path)
    return sources.read_json_list(spark, path, field="products", one_per_line=True).select("id", "brand", "price")


@register("s9_paged_records", """
    select ts as trip_pickup_date_time, value as tip_amt, event_type as payment_type,
      cast(event_id // 1000 + 1 as int) as page from events""")
def s9(spark, sf):
    path = scratch_path(spark, "s9")
    rows = feeds.table(spark, sf, "events").select(
        F.col("ts").alias("trip_pickup_date_time"), F.col("value").alias("tip_amt"),
        F.col("event_type").alias("payment_type"),
        (F.floor(F.col("event_id") / 1000) + 1).alias("page"),
    )
    columns = ["trip_pickup_date_time", "tip_amt", "payment_type"]
    sources.write_pages(rows, path, "page", columns)
    schema = T.StructType([
        T.StructField(columns[0], T.TimestampNTZType()), T.StructField(columns[1], T.DoubleType()),
        T.StructField(columns[2], T.StringType()),
    ])
    return sources.read_pages(spark, path, schema)


_MESSAGE_SCHEMA = T.StructType([
    T.StructField("event_id", T.LongType()), T.StructField("ts", T.StringType()),
    T.StructField("user_id", T.LongType()), T.StructField("trip_distance", T.DoubleType()),
])
_MESSAGE_COLUMNS = _MESSAGE_SCHEMA.names


def _messages(spark, sf, name):
    path = scratch_path(spark, name)
    events = feeds.table(spark, sf, "events").withColumn("trip_distance", F.expr("nullif(value, 1.0)"))
    write_messages(events, path, _MESSAGE_COLUMNS)
    return path


@register("s10_event_stream", """
    select event_id, strftime(ts, '%Y-%m-%d %H:%M:%S') as ts, user_id, nullif(value, 1.0) as trip_distance from events""")
def s10(spark, sf):
    stream = sources.stream_event_files(spark, _messages(spark, sf, "s10"), _MESSAGE_SCHEMA)
    out = scratch_path(spark, "s10-out")
    append_windows(stream, out, scratch_path(spark, "s10-state"), available_now=True).awaitTermination()
    return spark.read.schema(_MESSAGE_SCHEMA).parquet(out)


_COUNTS_SQL = """select count(*) as total_messages, count(*) filter (where coalesce(nullif(value, 1.0), 0) > 5.0) as long_trips
    from events"""


@register("s11_bounded_topic_counts", _COUNTS_SQL)
def s11(spark, sf):
    return sources.bounded_counts(sources.read_event_files(spark, _messages(spark, sf, "s11"), _MESSAGE_SCHEMA))


@register("s11_read_until_idle", _COUNTS_SQL)
def s11_idle(spark, sf):
    # a continuous read that ends by itself when no message has come for a while
    stream = sources.stream_event_files(spark, _messages(spark, sf, "s11i"), _MESSAGE_SCHEMA)
    return count_until_idle(
        stream, scratch_path(spark, "s11-counters"), scratch_path(spark, "s11-state"), idle_seconds=2.0, every="0 seconds",
        name=f"s11-{uuid.uuid4().hex}")


@register("s12_checked_seed", """
    select n_nationkey as LocationID, r_name as Borough, n_name as Zone,
      case when r_name = 'EUROPE' then 'Yellow Zone' else 'Boro Zone' end as service_zone
    from nation join region on n_regionkey = r_regionkey where r_name <> 'MIDDLE EAST'""")
def s12(spark, sf):
    path = _as_csv(feeds.zone_lookup(spark, sf), "s12")
    return sources.load_seed(spark, path, ZONE_LOOKUP, ["LocationID"], ["LocationID"])


@register("s13_month_files", """
    select o_orderkey, o_orderdate, o_orderstatus,
      case when o_orderstatus = 'P' then cast(o_custkey as double) else o_totalprice end as fee,
      case when o_orderstatus = 'F' then o_orderpriority end as note
    from orders""")
def s13(spark, sf):
    # the kinds differ in shape (a note, none, an integer fee); kind X has no files
    root = scratch_path(spark, "s13")
    orders = feeds.table(spark, sf, "orders").withColumn("month", F.trunc("o_orderdate", "month"))
    base = ["o_orderkey", "o_orderdate", "o_orderstatus"]
    fee = F.col("o_totalprice").alias("fee")
    shapes = {"F": [fee, F.col("o_orderpriority").alias("note")], "O": [fee], "P": [F.col("o_custkey").alias("fee")]}
    for kind, extra in shapes.items():
        (orders.where(F.col("o_orderstatus") == kind).select(*base, *extra, "month")
         .hint("rebalance", F.col("month")).write.partitionBy("month").parquet(f"{root}/{kind}"))
    first, last = orders.agg(F.min("o_orderdate"), F.max("o_orderdate")).first()
    units = sources.month_units("FOPX", first.date(), next_month(last.date().replace(day=1)))
    rows, missing = sources.read_units(spark, units, lambda kind, month: f"{root}/{kind}/month={month}")
    assert "X" in {kind for kind, _ in missing}
    return rows.select(*base, "fee", "note")


@register("s13_indexed_files_of_an_interval", """
    select o_orderkey, o_orderdate, o_totalprice from orders where o_orderdate >= '1995-03-10' and o_orderdate < '1995-06-20'""")
def s13_index(spark, sf):
    # footers are read once and kept; the second read takes from the index which files hold the interval
    root, index = scratch_path(spark, "s13x"), scratch_path(spark, "s13x-index")
    orders = feeds.table(spark, sf, "orders").select("o_orderkey", "o_orderdate", "o_totalprice")
    orders.withColumn("month", F.trunc("o_orderdate", "month")).hint("rebalance", F.col("month")).write.partitionBy("month").parquet(root)
    start, end = datetime(1995, 3, 10), datetime(1995, 6, 20)
    for _ in range(2):
        known = refresh(spark, index, [root], ["o_orderdate"])
    assert known.footers_read == 0
    return read_indexed(spark, known.files.where(may_hold("o_orderdate", start, end))).where(in_half_open("o_orderdate", start, end))


@register("s14_first_rows")
def s14(spark, sf):
    return sources.first_rows(feeds.table(spark, sf, "orders"), 100)


@register("s14_first_rows_are_known", "select least(count(*), 100) as first_rows, 0::bigint as unknown from orders")
def s14_known(spark, sf):
    orders = feeds.table(spark, sf, "orders")
    first = sources.first_rows(orders, 100).withColumn("picked", F.lit(1))
    known = orders.select(*orders.columns).withColumn("known", F.lit(1))
    return first.join(known, orders.columns, "left").agg(
        F.count("picked").alias("first_rows"), F.count_if(F.col("known").isNull()).alias("unknown"))


_TYPES = {
    "l_orderkey": "bigint", "l_partkey": "bigint", "l_suppkey": "bigint", "l_linenumber": "int", "l_quantity": "double",
    "l_extendedprice": "double", "l_discount": "double", "l_tax": "double", "l_returnflag": "string",
    "l_linestatus": "string", "l_shipdate": "timestamp_ntz",
}


@register("s15_table_profile", " union all ".join(
    f"select '{c}' as column_name, '{t}' as column_type, count(*) as row_count, count(*) - count({c}) as null_count from lineitem"
    for c, t in _TYPES.items()))
def s15(spark, sf):
    return sources.profile(feeds.table(spark, sf, "lineitem"))
