"""Dedup, star schema and its checks on hand-written rows."""

from datetime import date, datetime
from decimal import Decimal

import pytest
from conftest import SF_SMALL, rows
from pyspark.sql import functions as F

from farebox.operators import checks as k
from farebox.operators.aggregates import load_report, share_of_total
from farebox.operators.dedup import keep_first, keep_latest
from farebox.plans import analytics, marts, staging
from farebox.schemas import AMOUNTS, GREEN_CSV, PAYMENT_TYPE_LOOKUP, YELLOW_CSV, ZONE_LOOKUP

AT = datetime(2024, 3, 15, 10, 0, 59)


def _green(vendor=1, pickup=AT, dropoff=datetime(2024, 3, 15, 10, 1, 1), pu=74, do=75, payment=1, total=10.0, fare=8.5):
    return (vendor, pickup, dropoff, "N", 1, pu, do, 1, 2.5, fare, 0.5, 0.5, 1.0, 0.0, None, 0.3, total, payment, 1, 0.0)


def _yellow(vendor=2, pickup=AT, dropoff=datetime(2024, 3, 15, 10, 30), pu=74, do=1, payment=2, total=20.0):
    return (vendor, pickup, dropoff, 2, 3.0, 1, "N", pu, do, payment, 15.0, 0.0, 0.5, 0.0, 0.0, 0.3, total, 2.5)


@pytest.fixture
def build(spark):
    def make(green, yellow, zones=((74, "Manhattan", "East Harlem North", "Boro Zone"), (75, "Manhattan", "East Harlem South", "Boro Zone"))):
        unioned = marts.int_trips_unioned(
            staging.stg_green_tripdata(spark.createDataFrame(green, GREEN_CSV)),
            staging.stg_yellow_tripdata(spark.createDataFrame(yellow, YELLOW_CSV)))
        payments = spark.createDataFrame([(1, "Credit card"), (2, "Cash")], PAYMENT_TYPE_LOOKUP)
        trips = marts.int_trips(unioned, payments)
        dim = marts.dim_zones(spark.createDataFrame(list(zones), ZONE_LOOKUP))
        return unioned, trips, dim, marts.fct_trips(trips, dim)

    return make


def test_union_constants_and_null_vendor(build):
    unioned, *_ = build([_green(), _green(vendor=None)], [_yellow(), _yellow(vendor=None)])
    got = {r.service_type: r for r in unioned.collect()}
    assert unioned.count() == 2
    assert got["Yellow"].trip_type == 1 and got["Yellow"].ehail_fee == Decimal(0) and got["Green"].ehail_fee is None


def test_earliest_dropoff_wins_and_ties_are_settled(build):
    later = datetime(2024, 3, 15, 11)
    _, trips, *_ = build([_green(dropoff=later, do=1), _green(do=9), _green(do=8)], [])
    got = trips.collect()
    assert [r.dropoff_location_id for r in got] == [8]  # of two equal drop-offs the smaller remaining columns


def test_uncast_amounts_give_the_same_trips(spark):
    green = spark.createDataFrame([_green(), _green(total=9.99), _green(pu=1, fare=-0.005)], GREEN_CSV)
    yellow = spark.createDataFrame([_yellow(), _yellow(total=1e12 + 0.1), _yellow(vendor=None)], YELLOW_CSV)
    # a feed whose amounts are decimals already is cast as before
    exact = yellow.withColumn("total_amount", F.lit("12345678901234567.89").cast("decimal(20,2)"))
    payments = spark.createDataFrame([(1, "Credit card"), (2, "Cash")], PAYMENT_TYPE_LOOKUP)
    for other in (yellow, exact):
        cast, uncast = (
            marts.int_trips(marts.int_trips_unioned(
                staging.stg_green_tripdata(green, uncast=late), staging.stg_yellow_tripdata(other, uncast=late)), payments)
            for late in ((), AMOUNTS))
        assert uncast.schema.simpleString() == cast.schema.simpleString()
        assert sorted(map(tuple, uncast.collect()), key=str) == sorted(map(tuple, cast.collect()), key=str)
        assert cast.count() == 3


def test_payment_default_and_unknown_code(build):
    _, trips, *_ = build([_green(payment=None), _green(payment=5, pu=75), _green(payment=1, pu=1)], [])
    assert {(r.payment_type, r.payment_type_description) for r in trips.collect()} == {
        (0, "Unknown"), (5, "Unknown"), (1, "Credit card")}


def test_fact_keeps_unknown_zones_and_counts_minute_boundaries(build):
    *_, fact = build([_green(do=999)], [_yellow()])
    got = {r.service_type: r for r in fact.collect()}
    assert got["Green"].trip_duration_minutes == 1 and got["Green"].dropoff_zone is None
    assert got["Green"].pickup_zone == "East Harlem North" and got["Yellow"].trip_duration_minutes == 30
    assert fact.columns == marts.FACT_COLUMNS


def test_monthly_groups_by_the_shown_zone(build):
    """A trip without zone and a trip of a zone literally called 'Unknown Zone' are one group."""
    zones = ((74, "X", "Unknown Zone", "Boro Zone"),)
    _, trips, *_, fact = build([_green(pu=74), _green(pu=500, total=5.0)], [], zones)
    monthly = marts.fct_monthly_zone_revenue(fact).collect()
    assert [(r.pickup_zone, r.revenue_month, r.total_monthly_trips, r.revenue_monthly_total_amount) for r in monthly] == [
        ("Unknown Zone", date(2024, 3, 1), 2, Decimal("15.000000000"))]
    assert monthly[0].revenue_monthly_ehail_fee is None
    dimension = trips.sparkSession.createDataFrame([z[:3] for z in zones], "location_id int, borough string, zone string")
    assert [tuple(r) for r in marts.monthly_zone_revenue(trips, dimension).collect()] == [tuple(r) for r in monthly]


def test_questions_over_the_monthly_table(build):
    *_, fact = build([_green(), _green(pu=75, total=30.0)], [_yellow()])
    monthly = marts.fct_monthly_zone_revenue(fact)
    best = [tuple(r) for r in marts.best_zones(monthly, "Green", 2024).collect()]
    assert best == [("East Harlem South", Decimal("30.000000000")), ("East Harlem North", Decimal("10.000000000"))]
    assert marts.trips_in_month(monthly, "Green", "2024-03-01").first()[0] == 2
    assert marts.trips_in_month(monthly, "Green", "2024-04-01").first()[0] is None


def test_dimensions(build, spark):
    _, trips, zones, _ = build([_green(), _green(vendor=3)], [_yellow()])
    assert rows(marts.dim_vendors(trips)) == [(1, "Creative Mobile Technologies"), (2, "VeriFone Inc."), (3, None)]
    assert zones.columns == ["location_id", "borough", "zone", "service_zone"]


def test_model_checks(build):
    _, trips, zones, fact = build([_green(), _green(pu=500)], [_yellow()])
    assert {r.passed for r in marts.check_int_trips(trips).collect()} == {True}
    failed = {(r["check"], r["column"], r.failed_rows) for r in marts.check_fct_trips(fact, zones).collect() if not r.passed}
    assert failed == {("relationships", "pickup_location_id", 1), ("relationships", "dropoff_location_id", 1)}
    assert {r.passed for r in marts.check_dim_zones(zones).collect()} == {True}
    assert {r.passed for r in marts.check_monthly_revenue(marts.fct_monthly_zone_revenue(fact)).collect()} == {True}


def test_dedup_orders_nulls_last(spark):
    df = spark.createDataFrame([(1, None, "a"), (1, 5, "b"), (1, 7, "c")], "k int, o int, v string")
    assert rows(keep_first(df, ["k"], "o")) == [(1, 5, "b")]
    assert rows(keep_latest(df, ["k"], "o")) == [(1, 7, "c")]


def test_dedup_of_one_hot_key_is_cut_before_the_shuffle(spark, plan_of):
    """All rows share a key: each task passes on one row, whatever the group's size."""
    df = spark.range(0, 200_000, 1, 8).select(F.least("id", F.lit(0)).alias("k"), (-F.col("id")).alias("o"))
    kept = keep_first(df, ["k"], "o")
    assert rows(kept) == [(0, -199_999)]
    plan = plan_of(keep_first(df, ["k"], "o"))
    tree = plan[:plan.index("(1)")]
    assert tree.count("WindowGroupLimit") == 2 and tree.rindex("WindowGroupLimit") > tree.index("Exchange")


def test_row_checks_share_one_pass(spark, plan_of):
    df = spark.createDataFrame([(1, None, -1.0), (1, "x", 0.0), (None, "y", 2.0)], "a int, b string, c double")
    results = k.run_checks(df, [
        k.not_null("a"), k.accepted_values("b", ["x"]), k.non_negative("c"), k.positive("c"), k.unique("a"),
        k.unique_combination("a", "b")])
    assert {(r["check"], r["column"]): (r.failed_rows, r.total_rows, r.passed) for r in results.collect()} == {
        ("not_null", "a"): (1, 3, False), ("accepted_values", "b"): (1, 3, False), ("non_negative", "c"): (1, 3, False),
        ("positive", "c"): (2, 3, False), ("unique", "a"): (1, 2, False), ("unique_combination", "a,b"): (0, 3, True)}
    with pytest.raises(k.CheckFailed, match=r"not_null\(a\)"):
        k.assert_all(results)


def test_relationship_ignores_null_children(spark):
    child = spark.createDataFrame([(1,), (2,), (2,), (None,)], "k int")
    parent = spark.createDataFrame([(1,), (1,)], "id int")
    assert k.run_checks(child, [k.relationship("k", parent, "id")]).first()[2:] == (2, 3, False)


@pytest.mark.parametrize("now, status", [
    ("2024-01-02 00:00:00", "pass"), ("2024-01-02 00:00:01", "warn"), ("2024-01-03 00:00:01", "error")])
def test_freshness(spark, now, status):
    df = spark.sql("select timestamp_ntz '2024-01-01 00:00:00' as at")
    got = k.freshness(df, "at", now).first()
    assert got.status == status and got.passed == (status != "error")
    assert k.freshness(df.limit(0), "at", now).first().status == "error"


def test_custom_check(spark):
    df = spark.createDataFrame([("a",), ("a",)], "id string")
    assert k.scalar_equals("no_dup", k.duplicate_count(df, "id"), 0).first()[2:] == (1, 1, False)


def test_share_and_report(spark):
    df = spark.createDataFrame([("Credit",)] * 2 + [("Cash",)] * 5 + [(None,)], "payment_type string")
    assert rows(share_of_total(df, "payment_type")) == [("Cash", 5, 62.5), ("Credit", 2, 25.0), (None, 1, 12.5)]
    units = spark.createDataFrame([("2024-02", "g"), ("2024-01", "y"), ("2024-01", "y")], "month string, kind string")
    assert rows(load_report(units, ["month", "kind"])) == [("2024-01", "y", 2, 2), ("2024-02", "g", 1, 3)]
    assert rows(load_report(units, ["month"])) == [("2024-01", 2, 2), ("2024-02", 1, 3)]
    more = units.union(spark.createDataFrame([("2024-02", None), (None, "y"), ("2024-02", "y")], "month string, kind string"))
    assert sorted(rows(load_report(more, ["month", "kind"])), key=lambda r: r[3]) == [
        (None, "y", 1, 1), ("2024-01", "y", 2, 3), ("2024-02", None, 1, 4), ("2024-02", "g", 1, 5), ("2024-02", "y", 1, 6)]


def test_lookup_join_is_chosen_by_measured_size(spark, tmp_path, plan_of):
    """No hint and no job while the query is built: Spark broadcasts a lookup by the size of its files, else it shuffles."""
    spark.range(0, 50).select(F.col("id").cast("int").alias("payment_type"), F.lit("x").alias("description")).write.parquet(f"file:{tmp_path}/codes")
    trips = spark.range(1000).withColumnRenamed("id", "k")

    def joined():
        return marts.with_payment_label(trips, spark.read.parquet(f"file:{tmp_path}/codes"), F.col("k"))

    small, large = joined(), None
    assert "BroadcastHashJoin" in plan_of(small)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "10")
    try:
        large = joined()
        assert "SortMergeJoin" in plan_of(large)
        assert rows(small) == rows(large)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_hot_code_of_a_large_lookup_is_split(spark, plan_of):
    """Two thirds of the trips carry one code and the lookup is too large to broadcast."""
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2", "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20KB"}
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        trips = spark.range(0, 60_000, 1, 8).select(F.when(F.col("id") % 3 > 0, 0).otherwise(F.col("id")).alias("k"))
        lookup = spark.range(0, 60_000, 1, 8).select(F.col("id").alias("code"), F.lit("x").alias("label"))
        joined = trips.join(lookup, F.col("k") == F.col("code"), "left")
        assert joined.where("label is null").count() == 0
        assert "skew=true" in plan_of(joined, executed=True)
    finally:
        for key in settings:
            spark.conf.unset(key)


def test_mean_price_by_brand(spark):
    docs = ['{"brand": "A", "price": 1.0}', '{"brand": "A", "price": 2.0}', '{"price": 9}', '{"brand": null, "price": 4}', '{"brand": "B"}']
    df = spark.createDataFrame([(d,) for d in docs], "doc string")
    assert [tuple(r) for r in analytics.mean_price_by_brand(df, "doc").collect()] == [
        ("N/A", 9.0), (None, 4.0), ("A", 1.5), ("B", None)]


MODELS = ["dim_zones", "int_trips", "dim_vendors", "dim_payment_types", "fct_trips", "fct_monthly_zone_revenue"]


def _names(spark, database):
    return {r.tableName for r in spark.sql(f"show tables in {database}").collect() if not r.isTemporary and "__v_" not in r.tableName}


def test_build_publishes_all_models_or_none(spark, database, tmp_path):
    """A zone listed twice, then zones missing: the build stops and every stored model, the failed one included, keeps the
    rows of the last good build."""
    from farebox.plans.build import build_marts
    from workloads import feeds
    green, yellow = feeds.green_raw(spark, SF_SMALL), feeds.yellow_raw(spark, SF_SMALL)
    zones = feeds.zone_lookup(spark, SF_SMALL, skipped_region="")

    def build(lookup):
        build_marts(spark, database, f"file:{tmp_path}/db", green, yellow, feeds.payment_types(spark), lookup)

    with pytest.raises(k.CheckFailed, match="unique"):
        build(zones.union(zones.limit(1)))
    assert _names(spark, database) == {"check_results"}
    assert {r.tableName for r in spark.sql(f"show tables in {database} like 'dim_zones*'").collect()} == set()
    for _ in range(2):
        build(zones)
    assert _names(spark, database) == {"check_results", *MODELS}
    results = spark.table(f"{database}.check_results")
    assert results.where("not passed").count() == 0 and results.select("model").distinct().count() == 6
    trips = spark.table(f"{database}.fct_trips").count()
    assert trips and spark.table(f"{database}.fct_monthly_zone_revenue").agg(F.sum("total_monthly_trips")).first()[0] == trips
    stored = {m: rows(spark.table(f"{database}.{m}")) for m in MODELS}
    for lookup, failed in ((zones.union(zones.limit(1)), "unique"), (zones.where("Borough <> 'ASIA'"), "relationships")):
        with pytest.raises(k.CheckFailed, match=failed):
            build(lookup)
        assert {m: rows(spark.table(f"{database}.{m}")) for m in MODELS} == stored
        assert failed in {r["check"] for r in spark.table(f"{database}.check_results").where("not passed").collect()}
    build(zones)
    assert {m: rows(spark.table(f"{database}.{m}")) for m in MODELS} == stored


def test_row_checks_are_counted_while_writing(spark, database, monkeypatch):
    """The same outcomes as a pass over the stored rows, and one job fewer."""
    from farebox.operators import versions
    df = spark.range(0, 5000, 1, 4).select(F.expr("nullif(id, 17)").alias("id"), (F.col("id") - 3).alias("amount"), F.lit("a").alias("kind"))
    checks = [k.not_null("id"), k.non_negative("amount"), k.accepted_values("kind", ["b"]), k.positive("amount"), k.unique("kind")]

    def jobs_of(run):
        group = f"jobs-{run.__name__}"
        spark.sparkContext.setJobGroup(group, group)
        out = run()
        return out, len(spark.sparkContext.statusTracker().getJobIdsForGroup(group))

    def while_writing():
        counted, outcomes = k.watched(df, checks)
        version = versions.stage(counted, f"{database}.a")
        return outcomes() + k.run_other_checks(spark.table(version.table), checks)

    def afterwards():
        version = versions.stage(df, f"{database}.b")
        return [tuple(r) for r in k.run_checks(spark.table(version.table), checks[:4]).collect()] + k.run_other_checks(
            spark.table(version.table), checks)

    (first, few), (second, more) = jobs_of(while_writing), jobs_of(afterwards)
    assert sorted(first) == sorted(second) and few < more
    assert [o[2] for o in first] == [1, 3, 5000, 4, 1]
    plain, none = k.watched(df, [k.unique("kind")])
    assert plain is df and none() == []
