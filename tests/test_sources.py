"""Readers, on files written for the purpose."""

import gzip
import json
from datetime import date, datetime

import pytest
from conftest import rows

from farebox import sources
from farebox.operators.checks import CheckFailed
from farebox.operators.conform import ingest_shape, to_contract
from farebox.schemas import FHV_CONTRACT, GREEN_EVENT, PAYMENT_LOOKUP, PAGED_TRIP, YELLOW_CONTRACT, YELLOW_CSV, ZONE_LOOKUP
from farebox.streaming import to_messages
from pyspark.sql import functions as F


def test_csv_extra_column_and_bad_cell(spark, tmp_path):
    (tmp_path / "z.csv").write_text("LocationID,Borough,Zone,service_zone,extra\n1,EWR,Newark,EWR,x\nbad,Queens,Jamaica,Boro,y\n")
    got = sources.read_csv(spark, f"file:{tmp_path}/z.csv", schema=ZONE_LOOKUP)
    assert rows(got) == [(1, "EWR", "Newark", "EWR"), (None, "Queens", "Jamaica", "Boro")]
    with pytest.raises(Exception, match="MALFORMED"):
        sources.read_csv(spark, f"file:{tmp_path}/z.csv", schema=ZONE_LOOKUP, mode="FAILFAST").collect()


def test_csv_text_inferred_and_gzip(spark, tmp_path):
    for month in (1, 2):
        with gzip.open(tmp_path / f"t_{month}.csv.gz", "wt") as out:
            out.write(f"VendorID,fare\n1,{month}.5\n,3\n")
    text = sources.read_csv(spark, f"file:{tmp_path}/*.csv.gz")
    assert dict(text.dtypes) == {"VendorID": "string", "fare": "string"}
    typed = sources.read_csv(spark, f"file:{tmp_path}/*.csv.gz", infer=True, spread_over=3)
    assert dict(typed.dtypes) == {"VendorID": "int", "fare": "double"}
    assert typed.rdd.getNumPartitions() == 3
    assert rows(typed) == [(1, 1.5), (1, 2.5), (None, 3.0), (None, 3.0)]


def test_yellow_csv_to_staging_contract(spark, tmp_path):
    head = ",".join(YELLOW_CSV.names)
    line = "2,2024-01-01 00:10:00,2024-01-01 00:20:00,1,2.5,1,N,74,75,1,10.1,0.5,0.5,2,0,0.3,13.4,2.5"
    (tmp_path / "y.csv").write_text(f"{head}\n{line}\n,{line.split(',', 1)[1]}\n")
    raw = sources.read_csv(spark, f"file:{tmp_path}/y.csv", schema=YELLOW_CSV)
    staged = to_contract(raw, YELLOW_CONTRACT, required="VendorID").collect()
    assert len(staged) == 1 and str(staged[0].fare_amount) == "10.100000000" and staged[0].vendor_id == 2


def test_unsafe_cast_stops_safe_cast_gives_null(spark):
    fhv = spark.sql("""select 'B1' as dispatching_base_num, timestamp '2019-01-01' as pickup_datetime,
        timestamp '2019-01-01' as dropOff_datetime, 'x' as PUlocationID, '7' as DOlocationID, cast(null as string) as SR_Flag,
        'B1' as Affiliated_base_number union all select null, null, null, '1', '2', null, null""")
    got = to_contract(fhv, FHV_CONTRACT, required="dispatching_base_num").collect()
    assert [(r.pickup_location_id, r.dropoff_location_id) for r in got] == [(None, 7)]
    strict = [f for f in YELLOW_CONTRACT if f.name == "vendor_id"]
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        to_contract(spark.sql("select 'x' as VendorID"), strict).collect()


def test_json_document(spark, tmp_path):
    doc = {"products": [{"brand": "A", "price": 1.0}, {"price": 2.0}, {"brand": None, "price": 4.0}]}
    (tmp_path / "d.json").write_text(json.dumps(doc, indent=2))
    got = sources.read_json_list(spark, f"file:{tmp_path}/d.json", field="products")
    assert rows(got) == [("A", 1.0), (None, 2.0), (None, 4.0)]


def _page(folder, number, records):
    path = folder / f"page={number}"
    path.mkdir()
    (path / "body.json").write_text(json.dumps(records))


def _trip(tip):
    return {"trip_pickup_date_time": "2009-06-01T00:00:00", "tip_amt": tip, "payment_type": "Credit"}


@pytest.mark.parametrize("pages, kept", [
    ({1: 2, 2: 1, 3: 0, 4: 1}, {1, 2}),   # page 3 is empty: page 4 is never asked for
    ({1: 2, 3: 1}, {1}),                  # page 2 does not exist
    ({1: 0, 2: 5}, set()),
    ({1: 1, 2: 1}, {1, 2}),
])
def test_pages_stop_at_the_first_empty_one(spark, tmp_path, pages, kept):
    for number, count in pages.items():
        _page(tmp_path, number, [_trip(float(number))] * count)
    got = sources.read_pages(spark, f"file:{tmp_path}", PAGED_TRIP).collect()
    assert {r.page for r in got} == kept
    assert len(got) == sum(pages[p] for p in kept)


def test_later_pages_are_pruned(spark, tmp_path, plan_of):
    for number, count in {1: 1, 2: 0, 3: 1}.items():
        _page(tmp_path, number, [_trip(1.0)] * count)
    plan = plan_of(sources.read_pages(spark, f"file:{tmp_path}", PAGED_TRIP))
    assert "PartitionFilters: [isnotnull(page" in plan


@pytest.mark.parametrize("readers", [1, 3])
def test_pages_are_fetched_in_parallel_up_to_the_empty_one(spark, tmp_path, readers):
    """Page 4 is empty. Three readers also fetch page 5; the stop rule leaves it out."""
    for page in range(1, 12):
        (tmp_path / f"{page}.json").write_text(json.dumps([_trip(float(page))] * 2 if page < 4 or page == 5 else [], indent=1))
    sources.land_pages(spark, f"file://{tmp_path}/{{page}}.json", f"file:{tmp_path}/landed", readers)
    got = sources.read_pages(spark, f"file:{tmp_path}/landed", PAGED_TRIP).collect()
    assert sorted((r.page, r.tip_amt) for r in got) == [(p, float(p)) for p in (1, 1, 2, 2, 3, 3)]


def test_month_units():
    assert sources.month_units(["y", "g"], date(2024, 11, 30), date(2025, 1, 1)) == [
        ("y", date(2024, 11, 1)), ("g", date(2024, 11, 1)), ("y", date(2024, 12, 1)), ("g", date(2024, 12, 1))]
    # a start on the 31st steps through short months too
    assert [m for _, m in sources.month_units(["y"], date(2024, 1, 31), date(2024, 3, 2))] == [
        date(2024, 1, 1), date(2024, 2, 1), date(2024, 3, 1)]


def test_month_files_with_drift_and_gap(spark, tmp_path):
    """A fee that is integer in one month and double in another, one month missing, one with an extra column."""
    spark.sql("select 1 as id, 2L as airport_fee").write.parquet(f"file:{tmp_path}/y-2024-01")
    spark.sql("select 2 as id, 1.25D as airport_fee").write.parquet(f"file:{tmp_path}/y-2024-03")
    spark.sql("select 3 as id, 4.5D as airport_fee, 'n' as note").write.parquet(f"file:{tmp_path}/y-2024-04")
    units = sources.month_units(["y"], date(2024, 1, 1), date(2024, 5, 1))
    got, missing = sources.read_units(spark, units, lambda kind, m: f"file:{tmp_path}/{kind}-{m:%Y-%m}")
    assert missing == [("y", date(2024, 2, 1))]
    assert dict(got.dtypes)["airport_fee"] == "double"
    assert rows(got) == [(1, 2.0, None), (2, 1.25, None), (3, 4.5, "n")]


@pytest.mark.parametrize("trial", range(10))
def test_two_schemas_in_one_folder(spark, tmp_path, trial):
    """A column that only one file of a month has is kept, whichever file is looked at first."""
    spark.sql("select 1 as id").write.parquet(f"file:{tmp_path}/y")
    spark.sql("select 2 as id, 0.5D as fee").write.mode("append").parquet(f"file:{tmp_path}/y")
    got, missing = sources.read_units(spark, [("y", date(2024, 1, 1))], lambda kind, m: f"file:{tmp_path}/{kind}")
    assert missing == [] and rows(got.select("id", "fee")) == [(1, None), (2, 0.5)]


def test_all_months_missing(spark, tmp_path):
    got, missing = sources.read_units(spark, [("y", date(2024, 1, 1))], lambda kind, m: f"file:{tmp_path}/none")
    assert got is None and len(missing) == 1


def test_seed_is_refused_when_keys_repeat(spark, tmp_path):
    (tmp_path / "p.csv").write_text("payment_type_id,payment_type_name\n1,card\n2,cash\n")
    path = f"file:{tmp_path}/p.csv"
    assert sources.load_seed(spark, path, PAYMENT_LOOKUP, ["payment_type_id"], ["payment_type_id"]).count() == 2
    (tmp_path / "p.csv").write_text("payment_type_id,payment_type_name\n1,card\n1,cash\n")
    with pytest.raises(CheckFailed, match="unique"):
        sources.load_seed(spark, path, PAYMENT_LOOKUP, ["payment_type_id"], ["payment_type_id"])


def test_profile_and_first_rows(spark):
    df = spark.createDataFrame([(1, None), (2, "x")], "a int, `b.c` string")
    assert rows(sources.profile(df)) == [("a", "int", 2, 0), ("b.c", "string", 2, 1)]
    assert sources.first_rows(df, 1).count() == 1 and sources.first_rows(df).count() == 2


def test_bounded_counts_treat_missing_and_nan(spark):
    messages = spark.createDataFrame([
        ('{"trip_distance": 6.0}',), ('{"trip_distance": null}',), ('{"PULocationID": 1}',), ('{"trip_distance": 5.0}',)], "value string")
    assert tuple(sources.bounded_counts(sources.parse_events(messages)).first()) == (4, 1)
    nan = spark.createDataFrame([(float("nan"),), (7.0,)], "trip_distance double")
    assert tuple(sources.bounded_counts(nan).first()) == (2, 1)


def test_messages(spark):
    trip = spark.sql("""select timestamp '2025-10-01 00:00:09.5' as lpep_pickup_datetime, timestamp '2025-10-01 00:10:00' as lpep_dropoff_datetime,
        74 as PULocationID, 75 as DOLocationID, cast(null as double) as passenger_count, double('NaN') as trip_distance,
        1.5D as tip_amount, 10.0D as total_amount""")
    text = to_messages(trip).first()[0]
    assert json.loads(text) == {
        "lpep_pickup_datetime": "2025-10-01 00:00:09", "lpep_dropoff_datetime": "2025-10-01 00:10:00", "PULocationID": 74,
        "DOLocationID": 75, "passenger_count": 0.0, "trip_distance": None, "tip_amount": 1.5, "total_amount": 10.0}
    assert sources.parse_events(to_messages(trip), GREEN_EVENT).first().tip_amount == 1.5


def test_ingest_shape(spark):
    raw = spark.sql("""select 1.0D as VendorID, timestamp '2024-01-01 10:00:00' as lpep_pickup_datetime,
        timestamp '2024-01-01 10:05:00' as lpep_dropoff_datetime, double('NaN') as payment_type, double('NaN') as trip_distance, 3 as PULocationID, 'drop me' as other""")
    got = ingest_shape(raw, "green", F.lit("2025-01-01").cast("timestamp_ntz")).first().asDict()
    assert got == {
        "vendor_id": 1, "pickup_datetime": datetime(2024, 1, 1, 10), "dropoff_datetime": datetime(2024, 1, 1, 10, 5),
        "pu_location_id": 3, "payment_type": None, "trip_distance": None, "taxi_type": "green", "extracted_at": datetime(2025, 1, 1)}


def test_topic_without_connector_says_so(spark):
    from pyspark.errors import AnalysisException
    from farebox.streaming import send_messages
    with pytest.raises(AnalysisException, match="(?i)kafka"):
        sources.read_event_topic(spark, "localhost:1", "green-trips")
    with pytest.raises(AnalysisException, match="(?i)kafka"):
        send_messages(spark.sql("select 1 as a"), "localhost:1", "green-trips", ["a"])
